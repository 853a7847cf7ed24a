"""What the operators of this package share: task-side state, text slices, tables."""

import re
import sys
from itertools import islice

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import newslake

# Tasks get this package's code by value, so executors need no installed copy.
cloudpickle.register_pickle_by_value(newslake)

WHITE = "\t\n\x0b\x0c\r "
_STORE = "_newslake_worker_state"


def worker_state(key, make):
    """An object that lives as long as the Python worker; code shipped by value has no lasting globals."""
    store = sys.__dict__.setdefault(_STORE, {})
    if key not in store:
        store[key] = make()
    return store[key]


class Memo(dict):
    """A bounded memo: ``compute`` fills what is missing. Two generations of ``limit`` entries at most; what is used
    again moves to the younger one, the older one goes when that is full. Long keys are not kept."""

    def __init__(self, compute, limit):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= 64:
            self.put(key, value)
        return value

    def put(self, key, value):
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value

    def put_all(self, values: dict):
        """Many at once, of which ``limit`` at most are kept."""
        if len(self) + len(values) > self.limit:
            self.older = dict(self)
            self.clear()
        self.update(islice(values.items(), self.limit))


_GAP = re.compile(r"[\t\n\x0b\x0c\r ]")


def slices(text: str, size: int = 1 << 18):
    """``text`` in order, in slices of about ``size`` characters which end before an ASCII white space."""
    start = 0
    while len(text) - start > size:
        gap = _GAP.search(text, start + size)
        if gap is None:
            break
        yield text[start:gap.start()]
        start = gap.start()
    yield text[start:] if start else text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list:
    """Column names like ``names`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        found.append(name)
    return found


def read_file(path: str) -> bytes:
    """A vocabulary file, read where the job is submitted and sent along with the tasks."""
    with open(path, "rb") as file:
        return file.read()
