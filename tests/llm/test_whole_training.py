"""The field is trained on whole texts, whatever their length."""

import numpy as np

from newslake.llm import quality


def test_every_line_of_a_graded_text_is_learned_from(spark, monkeypatch):
    texts = ["\n".join(f"line {k} of it." for k in range(200)) + "\nline 0 of it.", "short one.", "| menu | home |\n" * 130, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 0), (3, 0)], "doc_id bigint, quality int")
    seen = {}

    def train(self, places, mask, labels, begins=()):
        seen.update(places=places, mask=mask, labels=labels, begins=begins)
        return self
    monkeypatch.setattr(quality.Field, "train", train)
    quality.fit(docs, labels)
    whole = [quality.line_features(quality.lines_of(t))[0].tolist() for t in texts if t]
    assert seen["mask"].sum() == 201 + 1 + 130 and max(seen["mask"].sum(1)) == 64 and sum(seen["begins"]) == 3
    assert sorted(seen["places"][seen["mask"]].tolist()) == sorted(sum(whole, []))
    assert seen["labels"][seen["mask"]].sum() == 202


def test_only_texts_have_a_first_line():
    places, mask = np.zeros((2, 3, 1), np.int64), np.ones((2, 3), bool)
    labels = np.array([[0, 0, 0], [1, 1, 1]])
    field = quality.Field().train(places, mask, labels, rounds=20, begins=[True, False])
    assert field.first[0] > 0 > field.first[1]
    none = quality.Field().train(places, mask, labels, rounds=20, begins=[False, False])
    assert abs(none.first).max() < 0.05 < abs(field.first).min()
