"""Tables for the edge cases that every operator has to give a defined result for."""

LONG = ("Lorem ipsum, dolor sit amet. " * 40 + "\n") * 900
NOSPACE = "äbc" * 40_000

TEXTS = [
    None, "", " \n\t ", "one", "One", "a b c d e f", "a b c d e f", "a  b c d e\nf", "Größe İΣΟΣ é ́x ﬁ",
    "\x00\x01 \x1c\x1d x\x85y z", "<|endoftext|> hi <|startoftext|><s></s>[INST] x [/INST] \\ \\n",
    "# * $ % & | < >\n# * $\n# * $", "▁ ▁▁  a ", LONG, NOSPACE, "!" * 5000,
]


def documents(spark, texts=None, with_clashes=False):
    """Rows with nulls in all columns, ties and repeats; ``with_clashes`` adds columns named like those of results."""
    texts = TEXTS if texts is None else texts
    rows = [(k, t, "en", "src", None if t is None else len(t)) for k, t in enumerate(texts)]
    rows += [rows[-1], rows[4], (None, "no id here, but text", None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    if with_clashes:
        names = ("id key copies digest fp node root rep n_tokens ids_sha256 h number content member first sha kept keep_id "
                 "group_size fingerprint component_id start length score predicted toxic quality n_words family word").split()
        df = df.selectExpr("*", *(f"'clash' AS {n}" for n in names))
    return df


def empty(df):
    return df.limit(0)


def plain(df, *columns):
    """Rows as sorted tuples, nulls first."""
    rows = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))
