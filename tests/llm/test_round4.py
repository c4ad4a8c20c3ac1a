"""Findings of round 3 on the training-data operators."""

from __future__ import annotations

from folioflow.llm import toxicity


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """A word that marks toxic texts in one late shard only is learnt, and no labelled row is left out of fit or calibration."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 150)
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 40, raising=False)
    monkeypatch.setattr(toxicity, "TUNE_ROWS", 30, raising=False)
    rows = [(i, f"plain words of text {i % 13} here" + (" venom" if i % 3 == 0 else ""), "en") for i in range(600)]
    docs = spark.createDataFrame([*rows, (5, "plain words", "en"), (9000, "never labelled", None)], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _, _ in rows] + [(None, 1), (7000, 1)], "doc_id bigint, toxic int")
    fitted, tuned, passes = [], [], []
    round_, calibrate_ = toxicity._round, toxicity.calibrate

    def seen_round(fit_on, p, seen, number, n):
        fitted.append(fit_on.count())
        passes.append(n)
        round_(fit_on, p, seen, number, n)

    def seen_calibrate(m, told):
        tuned.append(told.count())
        calibrate_(m, told)

    monkeypatch.setattr(toxicity, "_round", seen_round)
    monkeypatch.setattr(toxicity, "calibrate", seen_calibrate)
    monkeypatch.setattr(toxicity, "STEPS", 1_200)
    model = toxicity.train(docs, labels)
    from zlib import crc32
    told = sum(crc32(str(i).encode()) % 3 != 1 for i, _, _ in rows)
    assert fitted[0] + tuned[0] == told and len(set(fitted)) == 1 and len(fitted) >= toxicity.ROUNDS and set(passes) == {1}
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs.where("doc_id < 600"), model).collect()}
    marked, others = [got[i] for i in got if i % 3 == 0], [got[i] for i in got if i % 3]
    assert sum(marked) / len(marked) > sum(others) / len(others) + 0.3
