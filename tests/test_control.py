import json

import pytest

from kgspark.plans import control
from kgspark.plans.config import ExtractionConfig


def _config(tmp_path, items, bad=False):
    (tmp_path / "a.json").write_text(json.dumps(items))
    sources = [{"name": "one", "kind": "articles", "provider": "file", "options": {"path": str(tmp_path / "a.json"), "v": len(items)}}]
    if bad:
        sources.append({"name": "two", "kind": "articles", "provider": "file", "options": {"path": str(tmp_path / "none.json")}})
    (tmp_path / "c.json").write_text(json.dumps({"root": str(tmp_path / "root"), "sources": sources, "keep_snapshots": 2}))
    return control.RunConfig.load(str(tmp_path / "c.json"))


def test_runs_end_to_end(spark, tmp_path):
    item = lambda k, text="The same body of text": {"url": f"https://site.org/{k}", "title": f"Claim number {k}", "content": text, "category": "False", "date": "2024-01-02", "language": "en"}
    first = control.run(spark, _config(tmp_path, [item(1), item(2), item(3, "Another one")], bad=True), stamp="s1")
    assert (first["observations"], first["documents"], first["reviews"], first["graphs"]) == (3, 2, 3, 1)
    assert first["sources"]["two"].startswith("failed") and first["lines"] == spark.read.text(f"{tmp_path}/root/snapshots/s1").count()
    ids = {r.record_key: r for r in control.Versions(spark, f"{tmp_path}/root/identities", control._IDENTIFIED).current().collect()}
    second = control.run(spark, _config(tmp_path, [item(1), item(3, "Another one")]), stamp="s2")
    assert second["observations"] == 2
    table = control.Versions(spark, f"{tmp_path}/root/observations", control._OBSERVED).current()
    assert table.count() == 3 and table.filter("not active").count() == 1
    again = {r.record_key: r for r in control.Versions(spark, f"{tmp_path}/root/identities", control._IDENTIFIED).current().collect()}
    assert all(again[k] == ids[k] for k in ids)
    assert control.run(spark, _config(tmp_path, [item(1), item(3, "Another one")]), stamp="s3")["removed"] == ["s1"]
    assert [r["status"] for r in control.Ledger(f"{tmp_path}/root/ledger").runs()] == ["complete"] * 3
    assert control.main(["runs", "--config", str(tmp_path / "c.json")]) == 0 and control.main(["run", "--config", str(tmp_path / "nothing")]) == 1


def test_ledger_has_one_writer_and_marks_the_abandoned(tmp_path):
    ledger = control.Ledger(str(tmp_path))
    with pytest.raises(RuntimeError, match="under way"), ledger.run("h"), ledger.run("h"):
        pass
    ledger._write({"id": "x", "config_hash": "h", "status": "running", "error": None, "summary": {}, "started_at": 0, "finished_at": None})
    with ledger.run("h"):
        pass
    assert {r["id"]: r["error"] for r in ledger.runs()}["x"] == "abandoned"


def test_cache_and_config(tmp_path):
    clock = [0.0]
    cache, calls = control.ResultCache(10, lambda: clock[0]), []

    def compute():
        calls.append(1)
        return [len(calls)]

    assert cache.get("n", "q", {"a": 1}, compute) == cache.get("n", "q", {"a": 1}, compute) == [1] and cache.get("n", "q", {"a": 2}, compute) == [2]
    clock[0] = 11
    assert cache.get("n", "q", {"a": 1}, compute) == [3] and cache.status()["live"] == 1

    def clears():
        cache.clear()
        return ["old"]

    assert cache.get("n", "r", {}, clears) == ["old"] and cache.status()["entries"] == 0
    (tmp_path / "c.json").write_text(json.dumps({"root": "r", "sources": [], "typo": 1}))
    with pytest.raises(ValueError, match="typo"):
        control.RunConfig.load(str(tmp_path / "c.json"))
    with pytest.raises(ValueError, match="unknown source"):
        control.SourceConfig("x", "nope", "file")


def test_a_run_with_all_stages(spark, tmp_path):
    from pyspark.sql import functions as F

    from kgspark.operators import enrichment, rdf

    item = lambda k, body: {"url": f"https://site.org/{k}", "title": f"Claim number {k}", "content": body, "category": "False", "date": "2024-01-02", "language": "en"}
    config = _config(tmp_path, [item(1, "Body one"), item(2, "Body two"), item(3, "Body three")])
    config = control.RunConfig(config.root, config.sources, extraction=ExtractionConfig(enabled=True, workers=2, delay_s=0, retries=0))
    asked, up = [], [False]

    def get(url):  # pages 1 and 2 are one page
        k = int(url[-1])
        return {"content": "The same page", "canonical_url": "https://site.org/one", "http_status": 200} if k < 3 else {"error_type": "http_error", "http_status": 503}

    mood = enrichment.Enricher("emotion", "1", "claim_uri", "claim_analysis", lambda texts: [json.dumps({"value": "Joy"}) for _ in texts], available=lambda: up[0])
    link = enrichment.Enricher("entities.claim", "1", "claim_uri", "claim_analysis", lambda texts: [json.dumps({"Resources": [{"@URI": "https://e.org/1", "@similarityScore": "0.9"}]}) for _ in texts], graph="https://kg.example.org/graph/entities")
    facts = spark.createDataFrame([("https://e.org/1", "https://p.org/label", "One", "literal")], "entity string, property string, value string, kind string")
    first = control.run(spark, config, stamp="s1", get=get, enrichers=[mood, link], facts=facts)
    assert first["documents"] == 2 and first["extraction"] == {"pending": 3, "succeeded": 2, "retryable": 1} and first["degraded"]
    assert first["enrichment"]["emotion"] == {"missing": 3, "available": False} and first["enrichment"]["entities.claim"]["succeeded"] == 3
    assert first["kept_graphs"] == ["https://kg.example.org/graph/one"] and first["graphs"] == 1  # no earlier snapshot to keep: only the entities
    assert asked == [] and {r.graph for r in rdf.read_lines(spark, first["snapshot"]).collect()} == {"https://kg.example.org/graph/entities"}
    up[0] = True
    second = control.run(spark, config, stamp="s2", get=get, enrichers=[mood, link], facts=facts)
    assert second["extraction"] == {"cached": 2, "deferred": 1} and second["enrichment"]["emotion"]["succeeded"] == 3 and second["kept_graphs"] == []
    q = rdf.line_quads(rdf.read_lines(spark, second["snapshot"]))
    assert q.filter("p like '%hasEmotion'").count() == 3 and q.filter("p = 'https://p.org/label' and o = 'One' and o_kind = 'literal'").count() == 1
    assert q.filter("p = 'http://schema.org/url' and o = 'https://site.org/one'").count() == 2
    table = {r["preferred_url"] for r in control.bootstrap(spark, config.root)["documents"].current().collect()}
    assert table == {"https://site.org/one", "https://site.org/3"}
    # a new observation of a URL that only a vanished one had is still that document
    gone = control.RunConfig(config.root, _config(tmp_path, [item(3, "Body three")]).sources, extraction=config.extraction)
    control.run(spark, gone, stamp="s3", get=get, enrichers=[mood, link])
    ids = control.bootstrap(spark, config.root)["identities"].current()
    back = control.RunConfig(config.root, _config(tmp_path, [item(2, "Body two") | {"title": "Another claim of it"}, item(3, "Body three"), item(4, "Body four"), item(5, "Body five")]).sources)
    control.run(spark, back, stamp="s4", enrichers=[mood, link], skip_enrichment=True)
    assert control.bootstrap(spark, config.root)["identities"].current().select("document_id").distinct().count() == ids.select("document_id").distinct().count() + 2
    kept = rdf.read_lines(spark, f"{config.root}/snapshots/s4")
    assert kept.filter("graph like '%one'").count() == rdf.read_lines(spark, f"{config.root}/snapshots/s3").filter("graph like '%one'").count()  # emotion of the new claims is missing
    assert control.purge(spark, config.root) > 0 and control.bootstrap(spark, config.root)["enrichments"].current().count() == 0
    assert control.activate(spark, config.root, first["snapshot"].replace("s1", "s3"), ["https://kg.example.org/graph/one"]) is None
    with pytest.raises(ValueError, match="lacks"):
        control.activate(spark, config.root, f"{config.root}/snapshots/s4", ["https://kg.example.org/graph/none"])
    assert control.served(spark, config.root).filter(F.col("p").endswith("hasEmotion")).count() > 0


def test_config_is_strict(tmp_path):
    from kgspark.plans.config import RunConfig, build

    source = {"name": "a", "kind": "articles", "provider": "wiki", "options": {}}
    good = {"root": "r", "sources": [source], "extraction": {"enabled": True, "workers": 4}, "enrichment": {"linker": {"enabled": True}, "properties": {"enabled": True, "properties": ["p"]}}}
    config = build(RunConfig, good)
    assert config.extraction.workers == 4 and config.enrichment.properties.properties == ("p",) and config.extraction.delays()["dns"] == 168
    for bad, match in (({"typo": 1}, "unknown"), ({"extraction": {"workers": 0}}, "positive"), ({"extraction": {"workers": "4"}}, "wrong type"), ({"enrichment": {"properties": {"enabled": True}}}, "linker"), ({"logging": {"level": "LOUD"}}, "level"), ({"output": {"format": "xml"}}, "N-Triples"), ({"sources": [source | {"kind": "x"}]}, "unknown source"), ({"sources": {}}, "list")):
        with pytest.raises(ValueError, match=match):
            build(RunConfig, good | bad)
    with pytest.raises(ValueError, match="missing"):
        build(RunConfig, {"root": "r"})
    assert config.hash() == build(RunConfig, good | {"logging": {"level": "DEBUG"}}).hash() != build(RunConfig, good | {"root": "s"}).hash()


def test_command_line_and_helpers(tmp_path, capsys):
    assert control.main([]) == 1 and control.main(["run", "-c", "x", "--skip-extraction", "--no-cache-extraction"]) == 1
    assert control.main(["purge-processing-results", "-c", "x"]) == 1
    assert [control.shown_bytes(n) for n in (5, 2048, 3 << 20)] == ["5 B", "2.0 KB", "3.0 MB"] and [control.shown_duration(s) for s in (5, 65, 3700)] == ["5s", "1m 05s", "1h 01m 40s"]
    clock = [0.0]
    p = control.Progress("stage", 100, 10, lambda: clock[0])
    clock[0] = 5
    assert p.update(10) is None
    clock[0] = 20
    assert p.update(40, {"ok": 40}) == "stage: 40 of 100, 2.0/s in 20s, 30s left, ok=40"
    from datetime import UTC, datetime

    when = datetime(2024, 1, 2, 3, 4, 5, tzinfo=UTC)
    assert control.snapshot_path("{ROOT}/{DATE}/{TIME}/{SOURCE}-{DATETIME}-{TIMESTAMP}", "/r/", when, "s") == "/r/2024-01-02/03-04-05/s-2024-01-02T030405-1704164645"
    cache = control.ResultCache()
    assert cache.refresh([("n", "a", {}, lambda: [1]), ("n", "b", {}, lambda: 1 // 0)]) == {"n:a": "refreshed", "n:b": "failed: integer division or modulo by zero"}


def test_metrics_facade(spark):
    from kgspark.plans import metrics, views

    m = control.Metrics(lambda: views.processing_results(spark, "/root/testdata/sf0.001"), {"success": metrics.success_rate, "errors": lambda t, limit: metrics.error_types(t, limit)})
    assert len(m.get("success")) == 5 and m.get("errors", limit=3) == m.get("errors", limit=3)
    with pytest.raises(ValueError, match="1 to 1000"):
        m.get("errors", limit=0)
    with pytest.raises(KeyError):
        m.get("nothing")
