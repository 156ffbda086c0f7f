import json

import pytest

from chatterloom import cli
from chatterloom.operators import governance
from chatterloom.sources import artifacts

AT = 1_700_000_000_000


@pytest.fixture
def root(tmp_path):
    box = tmp_path / "inbox" / "bo_1"
    box.mkdir(parents=True)
    rows = [{"sender_name": "Me" if i % 2 else "Bo", "timestamp_ms": AT + i * 60_000, "content": f"plan b{i} mail me@mail.example.com"} for i in range(12)]
    (box / "message_1.json").write_text(json.dumps({"participants": [{"name": "Bo"}, {"name": "Me"}], "messages": rows}))
    (tmp_path / "config.json").write_text(json.dumps({"platform": "messenger", "export_path": "x", "my_name": "Me"}))
    return tmp_path


def test_commands(spark, root, capsys):
    lines = str(root / "exports/normalized/messages.jsonl")
    run = lambda *a: cli.main([str(x) for x in a], spark)
    assert run("check-freshness", "messages", "--root", root) == 1
    assert run("parse", "messenger", root, "--me", "Me", "--out", lines, "--config", root / "config.json") == 0
    assert run("check-freshness", "messages", "--root", root) == 0
    assert run("check-freshness", "stats", "--root", root) == 1
    d = artifacts.read_lines(spark, lines)
    assert d.count() == 12 and d.where("text like '%[redacted-email]%'").count() == 12
    assert run("filter", "--messages", lines, "--out", root / "contacts", "--total", 10, "--each-way", 5) == 0
    assert run("sample", "classify", "--messages", lines, "--out", root / "sample", "--n", 5, "--contact", "bo_1") == 0
    assert run("sample", "classify", "--messages", lines, "--out", root / "none", "--contact", "nobody") == 1
    assert run("classify-plan", "--contacts", root / "contacts", "--out", root / "shards") == 0
    results = root / "results"
    assert run("classify-progress", "--contacts", root / "contacts", "--results", results, "--fail-if-remaining") == 1
    assert run("classify-merge", "--contacts", root / "contacts", "--results", results, "--out", root / "merged", "--require-all") == 1
    results.mkdir()
    (results / "b.json").write_text(json.dumps({"contacts": [{"contact_id": "bo_1", "label": "friend", "confidence": 0.6}]}))
    (results / "a.json").write_text(json.dumps([{"contact_id": "bo_1", "label": "acquaintance", "confidence": 0.6}]))
    (results / "0.json").write_text(json.dumps({"contact_id": "bo_1", "label": "work_peer", "confidence": 0.6}))
    assert run("classify-progress", "--contacts", root / "contacts", "--results", results, "--fail-if-remaining") == 0
    assert run("classify-merge", "--contacts", root / "contacts", "--results", results, "--out", root / "merged", "--require-all") == 0
    got = spark.read.json(str(root / "merged")).first()
    assert (got["label"], got["duplicate"]) == ("friend", True)
    assert run("validate", "--classified", results) == 0
    (results / "c.json").write_text(json.dumps([{"contact_id": "x", "label": "enemy", "confidence": 3}]))
    assert run("validate", "--classified", results) == 1
    assert run("validate", "config", root / "config.json") == 0
    (root / "bad.json").write_text('{"platform": 3}')
    assert run("validate", "config", root / "bad.json") == 1
    assert run("classify-progress", "--contacts", root / "contacts", "--results", root / "nothing", "--next", 3) == 0
    assert run("sample", "classify", "--messages", lines, "--out", root / "mine", "--sender", "me", "--n", 3, "--full-under-chars", 1, "--buckets", 2) == 0
    assert {r["sender"] for r in spark.read.json(str(root / "mine")).collect()} == {"me"} and spark.read.json(str(root / "mine")).count() == 3
    assert run("stats", "--messages", lines, "--out", root / "stats", "--out-per-contact", root / "each") == 0
    assert spark.read.json(str(root / "each")).select("message_count", "lexical.total_tokens").first()[0] == 12
    capsys.readouterr()


def test_redact_again(spark, root):
    lines, person = str(root / "exports/normalized/messages.jsonl"), root / "memory/person/bo.md"
    cli.main(["parse", "messenger", str(root), "--me", "Me", "--out", lines], spark)
    person.parent.mkdir(parents=True)
    person.write_text("# Bo\nSaid B3 and b3.\n\n## Manual notes\n\nkept\n\n## End\n")
    done = governance.redact_again(spark, str(root), "bo", "b3", replacement="$1\\x")
    assert done == {"patterns": 1, "messages": 12, "document": True}
    texts = [r["text"] for r in artifacts.read_lines(spark, lines).collect()]
    assert sum("$1\\x" in t for t in texts) == 1 and not any("b3" in t for t in texts)
    assert any("b3" in r["text"] for r in artifacts.read_lines(spark, lines + ".bak").collect())
    text = person.read_text()
    assert "Said $1\\x and $1\\x." in text and text.index("redacted here") < text.index("## End")
    (root / "config.json").write_text('{"platform": "pigeon"}')
    with pytest.raises(ValueError, match="platform"):
        governance.redact_again(spark, str(root), "bo", "x")
    assert (root / "config.json").read_text() == '{"platform": "pigeon"}'


def test_without_an_inbox_or_a_configuration(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no inbox of instagram"):
        cli.main(["parse", "instagram", str(tmp_path), "--me", "Me", "--out", str(tmp_path / "out")], spark)
    assert governance.redact_again(spark, str(tmp_path), "_global_", "x")["patterns"] == 1
    assert json.loads((tmp_path / "config.json").read_text())["redaction"]["custom_patterns"][0]["pattern"] == "x"
    assert governance.redact_again(spark, str(tmp_path), "_global_", "y")["patterns"] == 2
    (tmp_path / "results").mkdir()
    (tmp_path / "results" / "a.json").write_text('[{"contact_id": "a", "confidence": "much"}]')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        artifacts.read_results(spark, str(tmp_path / "results")).collect()


def test_patterns_and_notes(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"redaction": {"custom_patterns": [{"pattern": "(", "is_regex": True}, {"pattern": "ok"}, {}]}}))
    with pytest.warns(UserWarning):
        assert [p["pattern"] for p in governance.custom_patterns(spark, str(tmp_path / "c.json"))] == ["ok"]
    assert governance.noted("a\n", "- n").endswith("## Manual notes\n\n- n\n")
    assert governance.config_with_defaults({"redaction": {"phone": False}})["redaction"]["email"] is True
