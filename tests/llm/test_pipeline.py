"""The stages of the pipeline, each on what its predecessor kept."""

import random

import corpus_pipeline
from tests.llm.cases import PASSAGE


def test_run(spark, tmp_path):
    rng = random.Random(2)
    words = [a + b for a in ("ka", "lo", "mi", "ne", "ru", "sta", "ve") for b in ("lun", "der", "pok", "sin", "tar", "wem", "zo")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(k, prose(150)) for k in range(200)]
    rows += [(200 + k, prose(40) + f" grobnitz{k % 5} " + prose(40)) for k in range(60)]
    rows += [(300, rows[0][1]), (301, rows[1][1]), (302, rows[2][1] + " ende")]
    rows += [(310, prose(60) + " " + PASSAGE + " " + prose(60))]
    rows += [(320, prose(60) + " write to me.too@example.org " + prose(60)), (321, None), (322, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t) if t else None) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    at = f"file://{tmp_path}"
    docs.coalesce(1).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(d, 1, int(200 <= d < 260)) for d, _ in rows if d < 290], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, at).collect()}
    assert not any(200 <= d < 260 for d in out)
    assert not {300, 301, 310} & set(out) and {0, 1, 2} <= set(out)
    assert "<EMAIL>" in out[320].text and "example.org" not in out[320].text
    assert len([d for d in out if d < 200]) >= 198
    assert all(r.pieces is not None and (r.n_chars == len(r.text) if r.text is not None else True) for r in out.values())
    kept = spark.read.parquet(f"{at}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, at)
        assert kept.columns == corpus_pipeline.COLUMNS, name


def test_short_items_alone(spark, tmp_path):
    at = f"file://{tmp_path}"
    spark.createDataFrame([(1, PASSAGE), (2, "Lisbon"), (3, "blue whale")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    rows = [(1, "the road to lisbon is long"), (2, "from lisbon he saw a blue whale at sea"), (3, f"so {PASSAGE} it was"), (4, "nothing of the kind")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.decontamination(spark, docs, at).collect()) == [1, 4]
