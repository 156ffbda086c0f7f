"""Commands: python -m chatterloom.cli COMMAND. Tables are folders of JSON lines."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import redact
from .operators import classify, governance, groups, sampling, schemas, stats
from .sources import artifacts, meta, sessions

# Folders of a thread export, by platform.
INBOXES = {
    "messenger": ["inbox", "your_facebook_activity/messages/inbox", "messages/inbox", "your_activity_across_facebook/messages/inbox"],
    "instagram": ["your_instagram_activity/messages/inbox", "messages/inbox", "inbox", "your_instagram_activity/messages/message_requests", "messages/message_requests", "message_requests"],
}


def inboxes(spark: SparkSession, root: str, platform: str) -> list[str]:
    """Every known inbox below root, else root itself if a folder in it holds threads; else an error."""
    root = root.rstrip("/")
    if found := [p for p in (f"{root}/{x}" for x in INBOXES[platform]) if artifacts.exists(spark, p)]:
        return found
    if artifacts.any_match(spark, f"{root}/*/message_*.json"):
        return [root]
    raise FileNotFoundError(f"no inbox of {platform} below {root}; looked for " + ", ".join(INBOXES[platform]))


def imported(spark: SparkSession, a: argparse.Namespace, of_groups: bool) -> DataFrame:
    if a.platform == "wechat":
        d = sessions.group_messages(spark, a.path, a.me, a.alias) if of_groups else sessions.messages(spark, a.path, a.me, a.alias, a.include_groups)
    else:
        read = meta.group_messages if of_groups else meta.messages
        d = read(spark, inboxes(spark, a.path, a.platform), a.me, a.alias, a.platform)
    return d if a.no_redact else d.withColumn("text", redact(F.col("text"), custom=governance.custom_patterns(spark, a.config)))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="chatterloom")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *flags: str, **typed) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        for f in flags:
            c.add_argument(f"--{f}", required=True)
        for f, v in typed.items():
            c.add_argument("--" + f.replace("_", "-"), **({"action": "store_true"} if v is False else {"type": type(v), "default": v}))
        return c

    for name in ("parse", "parse-groups"):
        c = command(name, "me", "out", config="config.json", include_groups=False, no_redact=False)
        c.add_argument("platform", choices=governance.PLATFORMS)
        c.add_argument("path")
        c.add_argument("--alias", action="append", default=[])
    command("stats", "messages", "out", total=100, each_way=50, out_global="", out_per_contact="")
    command("filter", "messages", "out", total=100, each_way=50)
    c = command("sample", "messages", "out", n=0, contact="", classified="", since="", until="", sender="", buckets=sampling.BUCKETS, full_under_chars=30_000)
    c.add_argument("mode", choices=("classify", "memory", "persona"))
    command("group-stats", "groups", "out")
    command("group-signals", "groups", "messages", "out")
    command("group-context", "groups", "out")
    command("classify-plan", "contacts", "out", classified="", results="", signals="", size=5)
    command("classify-progress", "contacts", "results", fail_if_remaining=False, next=0)
    command("classify-merge", "contacts", "results", "out", existing="", require_all=False)
    c = command("validate", classified="")
    c.add_argument("schema", nargs="?", choices=list(schemas.SCHEMAS))
    c.add_argument("path", nargs="?")
    c = command("check-freshness", root=".")
    c.add_argument("gate", choices=list(governance.GATES))
    c = command("redact", root=".", regex=False, flags="gi", replacement="[redacted-custom]")
    c.add_argument("slug")
    c.add_argument("pattern")
    return p


def labels(spark: SparkSession, path: str) -> DataFrame:
    """Labelled contacts of a folder of results; seq is their order by file."""
    d = artifacts.read_results(spark, path) if path else spark.createDataFrame([], artifacts.CLASSIFIED + ", file string")
    return d.withColumn("seq", F.struct("file", "contact_id"))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Runs a command; 1 if a gate or check fails."""
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    say = lambda **x: print(json.dumps(x, ensure_ascii=False, default=str))
    read = lambda p, s=artifacts.MESSAGE: artifacts.read_lines(spark, p, s)
    contacts = "contact_id string, contact_name string, message_count_total bigint, message_count_from_me bigint, message_count_from_them bigint, first_message_at timestamp, last_message_at timestamp, span_days bigint"
    if a.command in ("parse", "parse-groups"):
        say(rows=artifacts.write_lines(imported(spark, a, a.command == "parse-groups"), a.out))
    elif a.command == "stats":
        m = read(a.messages)
        artifacts.write_lines(stats.totals(m, a.total, a.each_way), f"{a.out}/totals")
        for at, scope, out in (("global", [], a.out_global), ("contact", ["contact_id"], a.out_per_contact)):
            artifacts.write_lines(stats.bundled(m, scope), out or f"{a.out}/{at}")
    elif a.command == "filter":
        c = stats.contact_stats(read(a.messages))
        artifacts.write_lines(stats.passing(c, a.total, a.each_way), a.out)
        say(**stats.filter_report(c, a.total, a.each_way).first().asDict())
    elif a.command == "sample":
        m = read(a.messages)
        for flag, keep in ((a.contact, F.col("contact_id") == a.contact), (a.sender, F.col("sender") == a.sender), (a.since, F.col("timestamp") >= F.lit(a.since or None).cast("timestamp")), (a.until, F.col("timestamp") <= F.lit(a.until or None).cast("timestamp"))):
            m = m.where(keep) if flag else m
        if a.mode == "persona":
            classified = labels(spark, a.classified)
            for r in sampling.label_quotas(classified, a.n or 800).collect():  # a row for each label
                say(**r.asDict())
            s = sampling.persona_sample(m, classified, a.n or 800, a.buckets)
        else:
            s = sampling.contact_sample(m, a.n or 200, a.full_under_chars, a.buckets)
        if not (n := artifacts.write_lines(m.join(s, ["contact_id", "seq"]).select("contact_id", "timestamp", "sender", "text", "media_type", "seq"), a.out)):
            print("no messages to sample from", file=sys.stderr)
            return 1
        say(rows=n)
    elif a.command in ("group-stats", "group-context", "group-signals"):
        g = read(a.groups, artifacts.GROUP_MESSAGE)
        if a.command == "group-signals":
            artifacts.write_lines(groups.signals(g, stats.contact_stats(read(a.messages))), a.out)
        elif a.command == "group-context":
            for k, d in {"contexts": groups.contexts(g), "participants": groups.top_participants(g), "terms": groups.top_terms(g), "own_terms": groups.top_terms(g, only_me=True)}.items():
                artifacts.write_lines(d, f"{a.out}/{k}")
        else:
            artifacts.write_lines(groups.tone_counts(g), f"{a.out}/counts")
            artifacts.write_lines(stats.bundled(groups.as_messages(g), []), f"{a.out}/stats")
    elif a.command == "classify-plan":
        signals = spark.read.json(a.signals) if a.signals else None
        t = classify.tasks(read(a.contacts, contacts), labels(spark, a.classified), labels(spark, a.results), signals)
        artifacts.write_shards(classify.shards(t, a.size), a.out)
        say(**classify.manifest(read(a.contacts, contacts), labels(spark, a.classified), labels(spark, a.results), a.size).first().asDict())
    elif a.command == "classify-progress":
        c, done = read(a.contacts, contacts), labels(spark, a.results)
        row = classify.progress(c, done).first().asDict()
        say(**row)
        for r in classify.waiting(c, done).select("contact_id", "contact_name", "message_count_total").limit(a.next).collect():  # as many as are asked for
            say(**r.asDict())
        return int(a.fail_if_remaining and row["remaining"] > 0)
    elif a.command == "classify-merge":
        d = classify.merge(read(a.contacts, contacts), labels(spark, a.existing), labels(spark, a.results))
        artifacts.write_lines(d, a.out)
        missing = d.where("missing").count()
        say(missing=missing)
        for r in d.where("missing").select("contact_id").orderBy("contact_id").limit(20).collect():  # a preview
            say(**r.asDict())
        return int(a.require_all and missing > 0)
    elif a.command == "validate":
        if a.schema:
            try:
                found = schemas.issues(a.schema, artifacts.read_document(spark, a.path))
            except ValueError as e:
                found = [("", "invalid_json", str(e))]
            for p, code, message in found:
                say(path=p, code=code, message=message)
            if not found:
                say(ok=a.schema, path=a.path)
            return int(bool(found))
        bad = classify.violations(labels(spark, a.classified))
        for r in bad.limit(100).collect():  # a report of the first hundred
            say(**r.asDict())
        return int(not bad.isEmpty())
    elif a.command == "check-freshness":
        bad = governance.stale(spark, a.root, a.gate)
        print("\n".join(bad) if bad else f"fresh: {a.gate}", file=sys.stderr if bad else sys.stdout)
        return int(bool(bad))
    else:
        say(**governance.redact_again(spark, a.root, a.slug, a.pattern, a.regex, a.flags, a.replacement))
    return 0


if __name__ == "__main__":
    sys.exit(main())
