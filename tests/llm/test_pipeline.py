"""The pipeline on a small fixture: each stage's decisions take effect, columns and clean documents stay."""

import random

import corpus_pipeline
from tests.llm import brute


def documents(spark, rows):
    """Documents with columns that operators use as names inside."""
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, link string, kept_text string, id long, row string")


def test_rows_without_id_and_repeated_rows(spark, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(4000)}" for _ in range(120)) for _ in range(4)]

    def row(i, t):
        return i, t, "en", "s", 1, "mine", "mine too", 7, "a row"

    rows = [row(1, texts[0]), row(1, texts[0]), row(None, texts[0]), row(None, texts[1]), row(None, texts[1]), row(None, texts[2]), row(2, texts[2]),
            row(3, texts[3] + " end"), row(4, texts[3]), row(5, ""), row(6, None), row(None, None), row(None, None)]
    docs = documents(spark, rows)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text, r.link, r.id) for r in kept.collect()), key=str) == sorted(
        [(1, texts[0], "mine", 7), (None, texts[1], "mine", 7), (2, texts[2], "mine", 7), (3, texts[3] + " end", "mine", 7),
         (5, "", "mine", 7), (6, None, "mine", 7), (None, None, "mine", 7)], key=str)
    cut = corpus_pipeline.substrings(spark, documents(spark, [row(1, "x " + texts[0]), row(2, texts[0] + " y"), row(None, "z"), row(3, None)]), "")
    assert {(r.doc_id, r.text, r.n_chars, r.link, r.kept_text) for r in cut.collect()} == {
        (1, "x", 1, "mine", "mine too"), (2, "y", 1, "mine", "mine too"), (None, "z", 1, "mine", "mine too"), (3, None, 1, "mine", "mine too")}
    assert corpus_pipeline.substrings(spark, documents(spark, rows).drop("n_chars"), "").columns == [c for c in docs.columns if c != "n_chars"]


def test_empty_tables(spark, tmp_path):
    folder, docs = str(tmp_path), documents(spark, [])
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_stages(spark, tmp_path):
    rng = random.Random(1)
    clean = [" ".join(f"w{rng.randrange(4000)}" for _ in range(120)) for _ in range(60)]
    passage = " ".join(f"p{i}" for i in range(60))
    made = [(i, t, "en", "s", len(t)) for i, t in enumerate(clean)]
    made += [(60, clean[3], "en", "s", 1), (61, clean[4] + " tail", "en", "s", 1), (62, clean[5] + " " + passage, "en", "s", 1),
             (63, passage + " " + " ".join(f"z{i}" for i in range(90)), "en", "s", 1), (64, None, "en", "s", None), (None, "no id", None, None, None)]
    made += [(100 + i, "| $ " * 60 + str(i), "en", "s", 1) for i in range(40)]
    folder = str(tmp_path)
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(60)] + [(100 + i, 0) for i in range(40)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(clean[7].split()[20:60]))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    frame, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, folder)
        if name != "pieces":
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        frame = spark.read.parquet(f"{folder}/{name}")
        seen[name] = {r["doc_id"]: r for r in frame.collect()}
    assert not set(seen["quality"]) & set(range(100, 140)) and set(range(60)) <= set(seen["quality"])
    assert {60, 61} & set(seen["near_duplicates"]) == set() and set(range(60)) <= set(seen["near_duplicates"])
    assert "p30" not in (seen["substrings"][63]["text"] or "") and seen["substrings"][0]["text"] == clean[0]
    assert 7 not in seen["decontamination"] and set(range(60)) - {5, 7} <= set(seen["decontamination"])
    library = brute.pieces()
    assert seen["pieces"][0]["ids_sha256"] == brute.sha(",".join(map(str, library.encode(clean[0]))))
