"""All blocks of a benchmark's report."""

from lambi.plans import rounds
from lambi.sources import tables as src


def test_results_report_has_the_tags(spark, tmp_path, monkeypatch):
    rows = [(10, 0, "user", "Men wi. Se sa!"), (11, 0, "user", "Non <ht-HT> mesye.")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    monkeypatch.setattr(rounds, "shared_folder", lambda _: str(tmp_path / "report"))
    assert {r["block"] for r in rounds.results_report(spark, str(tmp_path)).collect()} == {"results", "comparison"}
    got = {(r["model"], r["latency_ms"], r["tag"]): r["n"] for r in src.read_report(spark, str(tmp_path / "report"), "tags").collect()}
    # Sentences 0 of both conversations get a tag; the second has one of its own, which is its second word.
    assert got == {(m, ms, t): n for m in ("baseline", "tuned") for ms in (80, 320) for t, n in (("<fr-FR>", 2), ("<ht-HT>", 1))}
