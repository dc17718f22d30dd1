"""Commands over small tables, and settings."""

import pytest

from tesserae import cli
from tesserae.plans.settings import settings


def test_settings(tmp_path):
    assert settings("clean")["date_flag_years"] == 5 and settings("translate", "/nowhere.yml")["retries"] == 3
    (tmp_path / "c.yml").write_text("date_flag_years: 7\n")
    assert settings("clean", "/nowhere.yml", str(tmp_path / "c.yml"))["date_flag_years"] == 7
    assert settings("clean", str(tmp_path / "c.yml"), date_flag_years=9)["date_flag_years"] == 9
    for bad in ({"date_flag_year": 1}, {"date_flag_years": "five"}):
        with pytest.raises(ValueError):
            settings("clean", **bad)


def test_commands(spark, tmp_path):
    at = f"file://{tmp_path}"
    rows = [("A1", "s", "X", "speech", "Ann", "head_of_state", "accepted"), ("A2", "s", "X", "other", "Ann", "head_of_state", "accepted"), ("A2", "s", "X", "other", "Ann", "head_of_state", "accepted"), ("A3", "t", "Y", "speech", "Bob", "foreign_visitor", "accepted"), ("A4", "t", "Y", "speech", "", "", "error_call")]
    cleaned = spark.createDataFrame([(k, *r, "yes", "yes", "none", "", None, None, None) for k, r in enumerate(rows)], "ord int, doc_id string, source_id string, country string, document_type string, speaker string, speaker_type string, clean_status string, is_first_person string, is_substantive string, tenure_match string, gate_reason string, inclusion_tier string, speaker_review boolean, note string")
    cleaned.write.parquet(f"{at}/cleaned")
    assert cli.main(["clean", "--input", f"{at}/cleaned", "--output", f"{at}/again"], spark) == 5
    got = {r.doc_id: r.clean_status for r in spark.read.parquet(f"{at}/again").collect()}
    assert got == {"A1": "accepted", "A2": "rejected_not_representative", "A3": "rejected_foreign", "A4": "error_call"}
    assert cli.main(["merge", "--input", f"{at}/again", "--output", f"{at}/merged"], spark) == 2
    assert cli.main(["merge", "--keep", "all", "--country", "X", "--input", f"{at}/again", "--output", f"{at}/all", "--format", "csv"], spark) == 2
    texts = spark.createDataFrame([("s", k, f"A{k}", f"https://a.b/{k}", "t", "", "the same text") for k in range(3)], "source_id string, ord int, doc_id string, url string, title string, capture string, text string")
    texts.write.parquet(f"{at}/texts")
    assert cli.main(["duplicates", "--input", f"{at}/texts"], spark) == 1
    with pytest.raises(SystemExit):
        cli.main(["nothing"], spark)
