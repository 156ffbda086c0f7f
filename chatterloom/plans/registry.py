"""Queries by name, and the SQL that says the same. Doubles are rounded to six places on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import EMOJI, SWEARS, SWEARS_HAN, detect_lang, has_text, redact, result_file_name, slugify, tokens
from ..operators import classify, groups, memory, sampling, stats
from . import adapters
from .adapters import SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_sql(body: str, *views: str) -> str:
    need = [v for v in SQL if v in views]
    if "contacts" in need or "classified" in need or "results" in need:
        need = [v for v in SQL if v in {*need, "msg_events", "contacts"}]
    return ("WITH " + ", ".join(f"{v} AS ({SQL[v]})" for v in need) + " " if need else "") + body


def query(name: str, sql: str | None = None, *views: str):
    def put(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            d = f(spark, sf_dir)
            return d.select(*[F.round(F.col(c), 6).alias(c) if t == "double" else F.unix_millis(c).alias(c) if t == "timestamp" else F.col(c).cast("long").alias(c) if t in ("int", "bigint") else F.col(c) for c, t in d.dtypes])

        run.__name__ = name
        QUERIES[name] = run
        if sql:
            ORACLES[name] = with_sql(sql, *views)
        return run

    return put


def plain(name: str, make, sql: str | None, *views: str) -> None:
    query(name, sql, *views)(make)


A = adapters
HASTEXT = "sender = 'me' AND length(text) > 0"
plain("a01_contact_stats", lambda s, d: A.contacts(s, d), "SELECT contact_id, contact_name, message_count_total, message_count_from_me, message_count_from_them, first_ms AS first_message_at, last_ms AS last_message_at, span_days FROM contacts", "contacts")
plain("f01_threshold", lambda s, d: stats.passing(A.contacts(s, d), 50, 20).select("contact_id", "message_count_total"), "SELECT contact_id, message_count_total FROM contacts WHERE message_count_total >= 50 AND message_count_from_me >= 20 AND message_count_from_them >= 20", "contacts")
plain("a30_filter_report", lambda s, d: stats.filter_report(A.contacts(s, d), 50, 20), "SELECT 50::BIGINT AS total_threshold, 20::BIGINT AS each_way_threshold, count(*) AS total_contacts, count(*) FILTER (message_count_total >= 50 AND message_count_from_me >= 20 AND message_count_from_them >= 20) AS passed_count FROM contacts", "contacts")
plain("a02_global_totals", lambda s, d: stats.totals(A.msg_events(s, d), 50, 20), "SELECT sum(message_count_total)::BIGINT AS total_messages, sum(message_count_from_me)::BIGINT AS total_messages_from_me, count(*) AS total_contacts, count(*) FILTER (message_count_total >= 50 AND message_count_from_me >= 20 AND message_count_from_them >= 20) AS contacts_above_threshold FROM contacts", "contacts")

TOK = r"list_transform(list_filter(regexp_extract_all(text, '[\x{4E00}-\x{9FFF}]|[A-Za-z0-9]+(?:\.[0-9]+)?%?'), lambda x: regexp_matches(x, '[A-Za-z\x{4E00}-\x{9FFF}]')), lambda x: lower(x))"
HAN = r"[\x{4E00}-\x{9FFF}]"


def term_sql(view: str, n: int, top: int, least: int, scope: str) -> str:
    part = f"PARTITION BY {scope} " if scope else ""
    cols = f"{scope}, " if scope else ""
    if n == 1:
        rows = f"SELECT {cols}seq, unnest(t) AS term, generate_subscripts(t, 1) AS pos FROM tt"
    else:
        sl = f"t[i:i+{n - 1}]"
        rows = f"SELECT {cols}seq, CASE WHEN len(list_filter({sl}, lambda x: regexp_matches(x, '{HAN}'))) = {n} THEN array_to_string({sl}, '') ELSE array_to_string({sl}, ' ') END AS term, i AS pos FROM (SELECT {cols}seq, t, unnest(range(1, len(t) - {n - 2})) AS i FROM tt WHERE len(t) >= {n})"
    group = f"GROUP BY {cols}term"
    return f", tt AS (SELECT {cols}seq, {TOK} AS t FROM {view} WHERE {HASTEXT}), rr AS ({rows}), cc AS (SELECT {cols}term, count(*) AS count, min(seq * 1000000 + pos) AS seen FROM rr {group}), kk AS (SELECT *, row_number() OVER ({part}ORDER BY count DESC, seen) AS rank FROM cc) SELECT {cols}term, count, rank FROM kk WHERE rank <= {top} AND count >= {least}"


for name, n, top, least in (("a04_words", 1, 50, 1), ("a05_bigrams", 2, 30, 1), ("a06_trigrams", 3, 20, 3)):
    for tail, scope in (("", ["contact_id"]), ("_global", [])):
        plain(name + tail, lambda s, d, n=n, top=top, least=least, scope=scope: stats.top_terms(A.msg_docs(s, d), scope, n, top, least), None)
        ORACLES[name + tail] = f"WITH msg_docs AS ({SQL['msg_docs']})" + term_sql("msg_docs", n, top, least, ",".join(scope))

SWEAR_SQL = " + ".join(f"len(regexp_extract_all(text, '(?i)\\b(?:{p})\\b'))" for p in SWEARS) + " + len(regexp_extract_all(text, '{}')) - len(regexp_extract_all(text, '草莓'))".format(SWEARS_HAN.replace("(?!莓)", ""))  # RE2 has no look-ahead
LEX = ("a07_a10_lexical", ["contact_id"]), ("a07_a10_lexical_global", [])
for name, scope in LEX:
    cols = "".join(c + ", " for c in scope)
    group = " GROUP BY contact_id" if scope else ""
    plain(name, lambda s, d, scope=scope: stats.lexical(A.msg_docs(s, d), scope), None)
    ORACLES[name] = f"WITH msg_docs AS ({SQL['msg_docs']}), tt AS (SELECT {cols}{TOK} AS t, {SWEAR_SQL} AS sw FROM msg_docs WHERE {HASTEXT}), nn AS (SELECT {cols}t, sw, len(t) AS n, len(list_filter(t, lambda x: regexp_matches(x, '{HAN}'))) AS zh FROM tt), uu AS (SELECT {cols}count(DISTINCT w) AS unique_tokens FROM (SELECT {cols}unnest(t) AS w FROM tt){group}) SELECT {'nn.contact_id, ' if scope else ''}sum(n)::BIGINT AS total_tokens, sum(sw)::BIGINT AS swear_count, round(1000.0::DOUBLE * (sum(sw) / count(*)::DOUBLE), 6) AS swears_per_1k, round(sum(n - zh) / greatest(1, sum(n))::DOUBLE, 6) AS en_ratio, round(sum(zh) / greatest(1, sum(n))::DOUBLE, 6) AS zh_ratio, 0.0::DOUBLE AS other_ratio, round(count(*) FILTER (zh > 0 AND n > zh) / count(*)::DOUBLE, 6) AS code_switch_rate, any_value(unique_tokens)::BIGINT AS unique_tokens FROM nn " + ("LEFT JOIN uu ON nn.contact_id = uu.contact_id GROUP BY nn.contact_id" if scope else "CROSS JOIN uu")

WS_SQL = r"[\t-\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+$"
for tail, scope in (("", "contact_id"), ("_global", "")):
    cols, group, sc = (f"{scope}, ", f" GROUP BY {scope}", [scope]) if scope else ("", "", [])
    plain("a11_a13_punctuation" + tail, lambda s, d, sc=sc: stats.punctuation(A.msg_docs(s, d), sc), "SELECT " + cols + ", ".join(f"round(count(*) FILTER ({c}) / count(*)::DOUBLE, 6) AS {n}" for n, c in (("end_period", "e = '.'"), ("end_exclamation", "e = '!'"), ("end_question", "e = '?'"), ("end_ellipsis", "e = '…'"), ("end_none", "e <> '' AND e NOT IN ('.','!','?','…')"), ("ellipsis_rate", r"regexp_matches(text, '\.\.\.|…')"), ("question_rate", "regexp_matches(text, '[?？]')"), ("exclamation_rate", "regexp_matches(text, '[!！]')"), ("comma_rate", "regexp_matches(text, '[,，]')"))) + f", round(sum(len(regexp_extract_all(text, '[A-Z]'))) / greatest(1, sum(len(regexp_extract_all(text, '[A-Za-z]'))))::DOUBLE, 6) AS caps_rate FROM (SELECT *, right(regexp_replace(text, '{WS_SQL}', ''), 1) AS e FROM msg_docs WHERE {HASTEXT}){group}", "msg_docs")
    plain("a14_emoji" + tail, lambda s, d, sc=sc: stats.emoji(A.msg_docs(s, d), sc), f"SELECT {cols}sum(k)::BIGINT AS emoji_total, round(sum(k) / count(*)::DOUBLE, 6) AS emoji_per_message, round(count(*) FILTER (k > 0) / count(*)::DOUBLE, 6) AS emoji_message_ratio FROM (SELECT *, len(regexp_extract_all(text, '{EMOJI}')) AS k FROM msg_docs WHERE {HASTEXT}){group}", "msg_docs")
    ln = r"length(text) + len(regexp_extract_all(text, '[\x{10000}-\x{10FFFF}]'))"
    bins = ", ".join(f"count(*) FILTER (l >= {a}{f' AND l <= {b}' if b else ''}) AS len_{a}_{b or 'up'}" for a, b in stats.LENGTH_EDGES)
    plain("a15_a17_lengths" + tail, lambda s, d, sc=sc: stats.structure(A.msg_docs(s, d), sc), f"SELECT {cols}{bins}, round(avg(l), 6) AS mean_length, round(median(l)::DOUBLE, 6) AS median_length, list_sort(list(l))[least(count(*), floor(0.9::DOUBLE * count(*))::INT + 1)] AS p90_length FROM (SELECT *, {ln} AS l FROM msg_docs WHERE {HASTEXT}){group}", "msg_docs")
    part = f"PARTITION BY {scope} " if scope else ""
    plain("a18_bursts" + tail, lambda s, d, sc=sc: stats.bursts(A.msg_events(s, d), sc), f"SELECT {cols}count(*) - count(*) FILTER (gap <= 300000) AS bursts, round(count(*) / (count(*) - count(*) FILTER (gap <= 300000))::DOUBLE, 6) AS mean_size, round(coalesce(avg(gap) FILTER (gap <= 300000), 0) / 1000, 6) AS mean_gap_within, round(coalesce(avg(gap) FILTER (gap > 300000), 0) / 1000, 6) AS mean_gap_between FROM (SELECT *, ms - lag(ms) OVER ({part}ORDER BY ms, seq) AS gap FROM msg_events WHERE sender = 'me'){group}", "msg_events")
    plain("a19_hours" + tail, lambda s, d, sc=sc: stats.hours(A.msg_events(s, d), sc), "SELECT " + cols + ", ".join([f"count(*) FILTER (hour(t) = {k}) AS h{k:02d}" for k in range(24)] + [f"count(*) FILTER (dayofweek(t) = {k}) AS d{k}" for k in range(7)]) + f" FROM (SELECT *, make_timestamp(ms * 1000) AS t FROM msg_events WHERE sender = 'me'){group}", "msg_events")
    for op, asker in (("a20_reply_latency", "them"), ("r22_their_latency", "me")):
        plain(op + tail, lambda s, d, sc=sc, asker=asker: stats.reply_latency(A.msg_events(s, d), sc, asker), f"SELECT {cols}count(*) AS pairs, round(median(nx - ms) / 1000.0::DOUBLE, 6) AS median_latency_s FROM (SELECT *, first_value(CASE WHEN sender <> '{asker}' THEN ms END IGNORE NULLS) OVER (PARTITION BY contact_id ORDER BY ms, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nx FROM msg_events) WHERE sender = '{asker}' AND nx IS NOT NULL{group}", "msg_events")
plain("a14_top_emoji", lambda s, d: stats.top_emoji(A.msg_docs(s, d), ["contact_id"]), f"SELECT contact_id, emoji, count, rank FROM (SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY count DESC, seen) AS rank FROM (SELECT contact_id, emoji, count(*) AS count, min(seq * 1000000 + pos) AS seen FROM (SELECT contact_id, seq, unnest(e) AS emoji, generate_subscripts(e, 1) AS pos FROM (SELECT contact_id, seq, regexp_extract_all(text, '{EMOJI}') AS e FROM msg_docs WHERE {HASTEXT})) GROUP BY 1, 2)) WHERE rank <= 25", "msg_docs")
plain("w02_burst_ids", lambda s, d: stats.burst_ids(A.msg_events(s, d), ["contact_id"]), "SELECT contact_id, seq, sum(new) OVER (PARTITION BY contact_id ORDER BY ms, seq)::BIGINT AS burst FROM (SELECT *, CASE WHEN ms - lag(ms) OVER (PARTITION BY contact_id ORDER BY ms, seq) <= 300000 THEN 0 ELSE 1 END AS new FROM msg_events WHERE sender = 'me')", "msg_events")


def flat_bundle(s: SparkSession, d: str) -> DataFrame:
    """Some of the numbers of each contact's bundle."""
    b = stats.bundled(A.msg_docs(s, d), ["contact_id"], ("lexical", "words", "structure", "hours", "bursts"))
    top = F.get("words", F.lit(0))
    return b.select("contact_id", "contact_name", "message_count", F.col("lexical.total_tokens").alias("total_tokens"), F.size("words").cast("long").alias("words"), top["term"].alias("top_word"), top["count"].alias("top_count"), F.col("structure.p90_length").alias("p90_length"), F.col("hours.h00").alias("h00"), F.col("bursts.bursts").alias("bursts"))


plain("a03_per_contact", flat_bundle, None)
ORACLES["a03_per_contact"] = f"WITH msg_docs AS ({SQL['msg_docs']}), tt AS (SELECT contact_id, seq, {TOK} AS t FROM msg_docs WHERE {HASTEXT}), rr AS (SELECT contact_id, seq, unnest(t) AS term, generate_subscripts(t, 1) AS pos FROM tt), cc AS (SELECT contact_id, term, count(*) AS count, min(seq * 1000000 + pos) AS seen FROM rr GROUP BY 1, 2), kk AS (SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY count DESC, seen) AS rank FROM cc), w AS (SELECT contact_id, count(*) FILTER (rank <= 50) AS words, max(term) FILTER (rank = 1) AS top_word, max(count) FILTER (rank = 1) AS top_count, sum(count)::BIGINT AS total_tokens FROM kk GROUP BY 1), l AS (SELECT contact_id, list_sort(list(l))[least(count(*), floor(0.9::DOUBLE * count(*))::INT + 1)] AS p90_length FROM (SELECT contact_id, {ln} AS l FROM msg_docs WHERE {HASTEXT}) GROUP BY 1), b AS (SELECT contact_id, count(*) FILTER (gap IS NULL OR gap > 300000) AS bursts, count(*) FILTER (hour(make_timestamp(ms * 1000)) = 0) AS h00 FROM (SELECT contact_id, ms, ms - lag(ms) OVER (PARTITION BY contact_id ORDER BY ms, seq) AS gap FROM msg_docs) GROUP BY 1) SELECT m.contact_id, m.contact_id AS contact_name, count(*) AS message_count, any_value(total_tokens) AS total_tokens, any_value(words) AS words, any_value(top_word) AS top_word, any_value(top_count) AS top_count, any_value(p90_length) AS p90_length, any_value(h00) AS h00, any_value(bursts) AS bursts FROM msg_docs m LEFT JOIN w USING (contact_id) LEFT JOIN l USING (contact_id) LEFT JOIN b USING (contact_id) GROUP BY 1"
plain("j11_next_reply", lambda s, d: stats.replies(A.msg_events(s, d)), "SELECT contact_id, seq, nx - ms AS wait_ms FROM (SELECT *, first_value(CASE WHEN sender = 'me' THEN ms END IGNORE NULLS) OVER (PARTITION BY contact_id ORDER BY ms, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nx FROM msg_events) WHERE sender = 'them' AND nx IS NOT NULL", "msg_events")
plain("x01_languages", lambda s, d: stats.languages(A.msg_docs(s, d)), f"SELECT contact_id, CASE WHEN regexp_matches(text, '{HAN}') THEN 'zh' WHEN regexp_matches(text, '[A-Za-z]') THEN 'en' ELSE 'other' END AS language, count(*) AS messages FROM msg_docs WHERE length(text) > 0 GROUP BY 1, 2", "msg_docs")
plain("x02_tokens", lambda s, d: A.msg_docs(s, d).select("seq", F.array_join(tokens(F.col("text")), " ").alias("tokens")), f"SELECT seq, array_to_string({TOK}, ' ') AS tokens FROM msg_docs", "msg_docs")
plain("x03_redact", lambda s, d: A.msg_docs(s, d).select("seq", redact(F.col("text")).alias("text")), r"SELECT seq, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b', '[redacted-email]', 'g'), '(\+?\d[\d\s\-().]{7,}\d)', '[redacted-phone]', 'g'), '(?i)\b\d{1,5}\s+[A-Za-z][A-Za-z\s]{2,40}(Road|Rd|Street|St|Avenue|Ave|Lane|Ln|Drive|Dr|Boulevard|Blvd|Crescent|Place|Pl|Way|Court|Ct|Highway|Hwy)\b\.?', '[redacted-address]', 'g'), '\bsk-[A-Za-z0-9]{20,}\b', '[redacted-secret]', 'g'), '\bAKIA[0-9A-Z]{12,}\b', '[redacted-secret]', 'g'), '\bghp_[A-Za-z0-9]{20,}\b', '[redacted-secret]', 'g'), '\b[A-Za-z0-9_-]{32,}\.[A-Za-z0-9_-]{32,}\.[A-Za-z0-9_-]{32,}\b', '[redacted-secret]', 'g') AS text FROM msg_docs", "msg_docs")
plain("p26_slugify", lambda s, d: A.contacts(s, d).select("contact_id", slugify(F.col("contact_name"), F.col("contact_id")).alias("slug")), "SELECT contact_id, 'user-' || contact_id AS slug FROM contacts", "contacts")
plain("p27_result_file", lambda s, d: A.contacts(s, d).select("contact_id", result_file_name(F.col("contact_name")).alias("file")), "SELECT contact_id, rtrim(translate(base64(encode(contact_name)), '+/', '-_'), '=') || '.json' AS file FROM contacts", "contacts")

plain("a21_group_tone", lambda s, d: groups.tone_counts(A.group_msgs(s, d)), "SELECT count(*) AS total_messages, count(*) FILTER (sender = 'me') AS messages_from_me, count(DISTINCT group_id) AS groups FROM group_msgs", "group_msgs")
plain("a22_group_contexts", lambda s, d: groups.contexts(A.group_msgs(s, d)), "SELECT group_id, count(*) AS messages, count(*) FILTER (sender = 'me') AS messages_from_me, count(DISTINCT participant_id) AS participants, min(ms) AS first_at, max(ms) AS last_at FROM group_msgs GROUP BY group_id", "group_msgs")
plain("t07_top_participants", lambda s, d: groups.top_participants(A.group_msgs(s, d)), "SELECT group_id, participant_id, messages, participant_name, rank FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY messages DESC, seen) AS rank FROM (SELECT group_id, participant_id, count(*) AS messages, min_by(participant_name, seq) AS participant_name, min(seq) AS seen FROM group_msgs WHERE sender <> 'me' GROUP BY 1, 2)) WHERE rank <= 20", "group_msgs")
STOP = "(" + ", ".join(f"'{w}'" for w in groups.STOPWORDS) + ")"
plain("a23_group_terms", lambda s, d: groups.top_terms(A.group_msgs(s, d)), None)
ORACLES["a23_group_terms"] = f"WITH group_msgs AS ({SQL['group_msgs']}), tt AS (SELECT group_id, seq, {TOK} AS t FROM group_msgs WHERE length(text) > 0), rr AS (SELECT group_id, seq, unnest(t) AS term, generate_subscripts(t, 1) AS pos FROM tt), cc AS (SELECT group_id, term, count(*) AS count, min(seq * 1000000 + pos) AS seen FROM rr WHERE length(term) > 1 AND term NOT IN {STOP} GROUP BY 1, 2) SELECT group_id, term, count, rank FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY count DESC, seen) AS rank FROM cc) WHERE rank <= 25"


def flat_signals(s: SparkSession, d: str) -> DataFrame:
    """The signals of groups in which every message is one's own too, so that names can be found in texts; a contact's
    name is that of a language, which many texts hold."""
    langs = F.array(*[F.lit(f" {x} ") for x in ("de", "en", "es", "fr")])
    c = A.contacts(s, d).withColumn("contact_name", F.element_at(langs, (F.col("contact_id").cast("long") % 4 + 1).cast("int")))
    g = A.group_msgs(s, d)
    mine = g.where(F.col("text").isNotNull()).withColumns({"sender": F.lit("me"), "participant_id": F.lit("me"), "participant_name": F.lit("Me")})
    out = groups.signals(g.unionByName(mine), c)
    flat = lambda c: F.array_join(c, ",")
    terms = F.transform("address_terms_from_me", lambda x: F.concat(x["term"], F.lit("="), x["count"].cast("string")))
    return out.select("contact_id", "contact_name", flat("matched_participant_ids").alias("ids"), flat("matched_participant_names").alias("names"), "shared_groups", "messages_from_me", "messages_from_participant", flat(terms).alias("terms"), "evidence_source", "weight")


plain("a25_group_signals", flat_signals, "SELECT p.contact_id, any_value(name) AS contact_name, p.contact_id AS ids, 'User ' || p.contact_id AS names, count(*) AS shared_groups, coalesce(sum(own), 0)::BIGINT AS messages_from_me, sum(n)::BIGINT AS messages_from_participant, coalesce(any_value(terms), '') AS terms, 'group_chat' AS evidence_source, 'weak' AS weight FROM (SELECT contact_id, ([' de ', ' en ', ' es ', ' fr '])[contact_id::BIGINT % 4 + 1] AS name FROM contacts) c JOIN (SELECT group_id, participant_id AS contact_id, count(*) AS n FROM group_msgs GROUP BY 1, 2) p USING (contact_id) LEFT JOIN (SELECT group_id, count(*) FILTER (sender = 'me') + count(text) AS own FROM group_msgs GROUP BY 1) o ON o.group_id = p.group_id LEFT JOIN (SELECT contact_id, term || '=' || sum(k)::BIGINT AS terms FROM (SELECT q.contact_id, trim(([' de ', ' en ', ' es ', ' fr '])[q.contact_id::BIGINT % 4 + 1]) AS term, k FROM (SELECT DISTINCT participant_id AS contact_id, group_id FROM group_msgs) q JOIN (SELECT group_id, t.term, sum(((length(text) - length(replace(text, t.term, ''))) // length(t.term)) * CASE WHEN sender = 'me' THEN 2 ELSE 1 END) AS k FROM group_msgs, (VALUES ('de'), ('en'), ('es'), ('fr')) t(term) WHERE text IS NOT NULL GROUP BY 1, 2) u ON u.group_id = q.group_id AND u.term = trim(([' de ', ' en ', ' es ', ' fr '])[q.contact_id::BIGINT % 4 + 1])) GROUP BY contact_id, term HAVING sum(k) > 0) a ON a.contact_id = p.contact_id GROUP BY 1", "contacts", "group_msgs")
asked_terms = lambda s, d: A.group_msgs(s, d).select("group_id").distinct().select("group_id", F.explode(F.array(*map(F.lit, ("the", " and ", "of", "x", "no such")))).alias("term"))
plain("a24_mentions", lambda s, d: groups.mentions(A.group_msgs(s, d).withColumn("sender", F.lit("me")), asked_terms(s, d)), "SELECT group_id, term, sum(k)::BIGINT AS count FROM (SELECT group_id, term, (length(text) - length(replace(text, term, ''))) // length(term) AS k FROM group_msgs, (VALUES ('the'), ('and'), ('of'), ('no such')) t(term) WHERE text IS NOT NULL) GROUP BY 1, 2 HAVING sum(k) > 0", "group_msgs")


def topic_sql() -> str:
    """Uses of every term in every text, then of topics."""
    uses = " UNION ALL ".join(f"SELECT contact_id, seq, '{t}' AS topic, '{x}' AS term, len(regexp_extract_all(text, '" + (rf"(?i)\b{x}\b" if x.isascii() else x) + "')) AS k FROM tx" for t, w in sampling.TOPICS.items() for x in w.split())
    return f", tx AS (SELECT contact_id, seq, text FROM msg_docs WHERE length(text) > 0), uu AS ({uses}), mm AS (SELECT contact_id, seq, topic, sum(k) AS k FROM uu GROUP BY ALL), pp AS (SELECT contact_id, topic, count(*) FILTER (k > 0) AS message_count, sum(k)::BIGINT AS match_count FROM mm GROUP BY ALL), ss AS (SELECT contact_id, topic, term, sum(k)::BIGINT AS k FROM uu GROUP BY 1, 2, 3), rr AS (SELECT *, row_number() OVER (PARTITION BY contact_id, topic ORDER BY k DESC, term) AS r FROM ss WHERE k > 0), qq AS (SELECT contact_id, topic, string_agg(term || '=' || k, ',' ORDER BY r) AS terms FROM rr WHERE r <= 10 GROUP BY ALL), profile AS (SELECT pp.*, coalesce(terms, '') AS terms FROM pp LEFT JOIN qq USING (contact_id, topic))"


def flat_terms(c):
    return F.array_join(F.transform(c, lambda x: F.concat(x["term"], F.lit("="), x["count"].cast("string"))), ",")


plain("a26_topic_profile", lambda s, d: sampling.topic_profile(A.msg_docs(s, d), ["contact_id"]).withColumn("top_terms", flat_terms("top_terms")), None)
ORACLES["a26_topic_profile"] = f"WITH msg_docs AS ({SQL['msg_docs']}){topic_sql()} SELECT contact_id, topic, message_count, match_count, terms AS top_terms FROM profile"
plain("a27_text_chars", lambda s, d: sampling.total_text_chars(A.msg_docs(s, d), ["contact_id"]), f"SELECT contact_id, sum({ln})::BIGINT AS chars FROM msg_docs GROUP BY 1", "msg_docs")
STRIDE = "list_transform(range({q}), lambda i: floor(i * ({c} / {q}::DOUBLE))::BIGINT)"
plain("m01_uniform_stride", lambda s, d: sampling.uniform_stride(A.msg_events(s, d), ["contact_id"], 7).select("contact_id", "seq"), "SELECT contact_id, seq FROM (SELECT *, count(*) OVER (PARTITION BY contact_id) AS c, row_number() OVER (PARTITION BY contact_id ORDER BY ms, seq) - 1 AS r FROM msg_events) WHERE c <= 7 OR list_contains(" + STRIDE.format(q="7", c="c") + ", r)", "msg_events")


def strata_sql(name: str, view: str, n: str, among: str = "true", keep: str = "") -> str:
    """CTEs of which `name` has the columns of view (contact_id, ms, seq and `keep`) and a flag t: whether time strata of
    at most n messages of those for which `among` holds choose it."""
    cols = ", ".join(["contact_id", "ms", "seq", *([keep] if keep else [])])
    return f"""{name}0 AS (SELECT {cols}, ({among}) AS a, ({n})::BIGINT AS want FROM {view}),
{name}1 AS (SELECT *, count(*) OVER w AS n, min(ms) OVER w AS lo, max(ms) OVER w AS hi FROM {name}0 WINDOW w AS (PARTITION BY contact_id, a)),
{name}2 AS (SELECT *, CASE WHEN hi = lo THEN 0 ELSE least(4, floor((ms - lo) / ((hi - lo) / 5.0::DOUBLE)))::INT END AS b FROM {name}1),
{name}3 AS (SELECT *, count(*) OVER (PARTITION BY contact_id, a, b) AS k, row_number() OVER (PARTITION BY contact_id, a, b ORDER BY ms, seq) - 1 AS r, CASE WHEN hi = lo THEN want ELSE want // 5 + (b < want % 5)::BIGINT END AS q FROM {name}2),
{name}4 AS (SELECT *, a AND want > 0 AND (n <= want OR k <= q OR list_contains({STRIDE.format(q='q', c='k')}, r)) AS t0 FROM {name}3),
{name}5 AS (SELECT *, CASE WHEN n <= want THEN 0 ELSE greatest(0, want - sum(t0::INT) OVER (PARTITION BY contact_id, a)) END::BIGINT AS g, row_number() OVER (PARTITION BY contact_id, a, t0 ORDER BY ms, seq) - 1 AS r2, count(*) OVER (PARTITION BY contact_id, a, t0) AS m FROM {name}4),
{name} AS (SELECT {cols}, t0 OR (a AND NOT t0 AND g > 0 AND (m <= g OR list_contains({STRIDE.format(q='g', c='m')}, r2))) AS t FROM {name}5)"""


def topic_aware_sql(view: str, n: int) -> str:
    """CTEs of which `aware` has contact_id, seq of a topic-aware sample of n messages of view (contact_id, ms, seq, text):
    by time first, then topic by topic, as the format says, then by time again."""
    count = lambda w: " + ".join(f"len(regexp_extract_all(text, '" + (rf"(?i)\b{x}\b" if x.isascii() else x) + "'))" for x in w.split())
    flags = ", ".join(f"({count(w)}) > 0" for w in sampling.TOPICS.values())
    out = [f"ta AS (SELECT contact_id, ms, seq, [{flags}] AS f FROM {view})", strata_sql("tb", "ta", str(max(1, int(n * 0.65))), keep="f")]
    sums = ", ".join(f"(sum(f[{k + 1}]::INT) OVER c)::BIGINT" for k in range(7))
    out.append(f"tc AS (SELECT *, count(*) OVER c AS total, [{sums}] AS s FROM tb WINDOW c AS (PARTITION BY contact_id))")
    ranked = "list_transform(list_sort(list_filter(list_transform(range(1, 8), lambda k: [-s[k], k::BIGINT]), lambda x: x[1] < 0)), lambda x: x[2]::BIGINT)"
    out.append(f"t0 AS (SELECT contact_id, ms, seq, f, total, t, {ranked} AS o FROM tc)")
    for i in range(7):
        out.append(f"u{i} AS (SELECT *, {n} - sum(t::INT) OVER (PARTITION BY contact_id) AS l, coalesce(f[o[{i + 1}]], false) AS i FROM t{i})")
        out.append(f"v{i} AS (SELECT *, count(*) OVER (PARTITION BY contact_id, i) AS k, row_number() OVER (PARTITION BY contact_id, i ORDER BY ms, seq) - 1 AS r, greatest(1, ceil(l / greatest(1, len(o) - {i})::DOUBLE))::BIGINT AS q FROM u{i})")
        out.append(f"t{i + 1} AS (SELECT contact_id, ms, seq, f, total, o, t OR (i AND l > 0 AND (k <= q OR list_contains({STRIDE.format(q='q', c='k')}, r))) AS t FROM v{i})")
    out.append(f"tl AS (SELECT contact_id, ms, seq, total, t AS had, {n} - sum(t::INT) OVER (PARTITION BY contact_id) AS l FROM t7)")
    out.append(strata_sql("tm", "tl", "l", "NOT had", "total, had"))
    out.append(f"aware AS (SELECT contact_id, seq FROM tm WHERE total <= {n} OR had OR t)")
    return ", ".join(out)


plain("m02_time_stratified", lambda s, d: sampling.time_stratified(A.msg_events(s, d), ["contact_id"], 23).select("contact_id", "seq"), None)
ORACLES["m02_time_stratified"] = f"WITH msg_events AS ({SQL['msg_events']}), {strata_sql('x', 'msg_events', '23')} SELECT contact_id, seq FROM x WHERE t"
plain("m03_topic_aware", lambda s, d: sampling.topic_aware(A.msg_docs(s, d), 20), None)
ORACLES["m03_topic_aware"] = f"WITH msg_docs AS ({SQL['msg_docs']}), {topic_aware_sql('msg_docs', 20)} SELECT contact_id, seq FROM aware"
plain("m05_persona_quota", lambda s, d: sampling.persona_quota(A.classified(s, d), 800), "SELECT contact_id, label, lq AS label_quota, lq // c + (j < lq % c)::BIGINT AS quota FROM (SELECT contact_id, label, 800 // l + (i < 800 % l)::BIGINT AS lq, c, row_number() OVER (PARTITION BY label ORDER BY seq) - 1 AS j FROM classified JOIN (SELECT label, count(*) AS c, row_number() OVER (ORDER BY min(seq)) - 1 AS i, count(*) OVER () AS l FROM classified GROUP BY label) USING (label))", "classified")


def flat_tasks(s: SparkSession, d: str) -> DataFrame:
    t = classify.tasks(A.contacts(s, d), A.classified(s, d), A.results(s, d), groups.signals(A.group_msgs(s, d), A.contacts(s, d)))
    return t.select("contact_id", "result_file", "result_path", "sample_path", F.array_join("sample_command", " ").alias("sample_command"), F.col("group_signal.shared_groups").alias("shared_groups"))


FILE_SQL = "rtrim(translate(base64(encode(contact_id)), '+/', '-_'), '=') || '.json'"
plain("g01_tasks", flat_tasks, f"SELECT contact_id, {FILE_SQL} AS result_file, 'exports/classifications/' || {FILE_SQL} AS result_path, 'exports/samples/classify/' || {FILE_SQL} AS sample_path, 'python -m chatterloom.cli sample classify --contact ' || contact_id || ' --n 200 --out exports/samples/classify/' || {FILE_SQL} AS sample_command, (SELECT nullif(count(DISTINCT group_id), 0) FROM group_msgs WHERE participant_id = contact_id) AS shared_groups FROM contacts WHERE contact_id NOT IN (SELECT contact_id FROM classified) AND contact_id NOT IN (SELECT contact_id FROM results)", "classified", "results", "group_msgs")
plain("g02_shards", lambda s, d: classify.shards(classify.tasks(A.contacts(s, d), A.classified(s, d), A.results(s, d))).select("contact_id", "shard_index"), "SELECT contact_id, (row_number() OVER (ORDER BY message_count_total DESC, contact_id) - 1) // 5 + 1 AS shard_index FROM contacts WHERE contact_id NOT IN (SELECT contact_id FROM classified) AND contact_id NOT IN (SELECT contact_id FROM results)", "classified", "results")
plain("g03_merge", lambda s, d: classify.merge(A.contacts(s, d), A.classified(s, d), A.results(s, d)), "SELECT contact_id, label, label IS NULL AS missing, coalesce(k > 1, false) AS duplicate FROM (SELECT c.contact_id, CASE WHEN e.label_source IN ('manual_override', 'correction_override') THEN e.label ELSE coalesce(r.label, e.label) END AS label, k FROM contacts c LEFT JOIN classified e USING (contact_id) LEFT JOIN (SELECT contact_id, max_by(label, seq) AS label, count(*) AS k FROM results GROUP BY 1) r USING (contact_id))", "classified", "results")
plain("a28_duplicates", lambda s, d: A.results(s, d).groupBy("contact_id").count().where("count > 1").select("contact_id"), "SELECT contact_id FROM results GROUP BY 1 HAVING count(*) > 1", "results")
plain("a29_progress", lambda s, d: classify.progress(A.contacts(s, d), A.results(s, d)), "SELECT (SELECT count(*) FROM contacts) AS total, count(*) AS classified, 0::BIGINT AS extra, count(*) FILTER (k > 1) AS duplicates, (SELECT count(*) FROM contacts) - count(*) AS remaining FROM (SELECT contact_id, count(*) AS k FROM results GROUP BY 1)", "results")
plain("a31_manifest", lambda s, d: classify.manifest(A.contacts(s, d), A.classified(s, d), A.results(s, d)), "SELECT (SELECT count(*) FROM contacts) AS total, (SELECT count(*) FROM classified) AS existing, (SELECT count(DISTINCT contact_id) FROM results) AS completed, count(*) AS remaining, ceil(count(*) / 5.0)::BIGINT AS shards FROM contacts WHERE contact_id NOT IN (SELECT contact_id FROM classified) AND contact_id NOT IN (SELECT contact_id FROM results)", "classified", "results")
plain("r05_label_summary", lambda s, d: classify.label_summary(A.classified(s, d)), "SELECT label, count(*) AS contacts, count(*) FILTER (label_source = 'manual_override') AS manual_overrides FROM classified GROUP BY 1", "classified")
plain("r01_r04_confidence", lambda s, d: A.classified(s, d).select("contact_id", classify.bounded_confidence((F.col("seq") % 10) / 10.0, F.col("seq") % 4, F.col("seq") % 5, F.col("span_days"), F.col("label_source") == "manual_override", F.col("seq") % 7 == 0).alias("confidence")), "SELECT contact_id, round(CASE WHEN label_source = 'manual_override' THEN 1.0 WHEN span_days < 30 OR seq % 7 = 0 THEN least(c, 0.5) ELSE c END::DOUBLE, 6) AS confidence FROM (SELECT *, CASE WHEN seq % 4 >= 2 OR seq % 5 >= 3 THEN (seq % 10) / 10.0 ELSE least((seq % 10) / 10.0, 0.7) END AS c FROM classified)", "classified")
plain("r11_severity", lambda s, d: A.classified(s, d).select("contact_id", classify.decayed(F.when(F.col("seq") % 2 == 0, "high").otherwise("medium"), F.col("seq")).alias("severity")), "SELECT contact_id, CASE WHEN seq < 30 THEN s WHEN seq <= 90 THEN CASE WHEN s = 'high' THEN 'medium' ELSE 'low' END ELSE 'low' END AS severity FROM (SELECT *, CASE WHEN seq % 2 = 0 THEN 'high' ELSE 'medium' END AS s FROM classified)", "classified")
plain("r10_half_years", lambda s, d: A.msg_events(s, d).groupBy("contact_id", classify.half_year(F.col("timestamp")).alias("half")).agg(F.count("*").alias("messages")), "SELECT contact_id, (year(t) * 2 + floor((month(t) - 1) / 2.0 / 3))::BIGINT AS half, count(*) AS messages FROM (SELECT *, make_timestamp(ms * 1000) AS t FROM msg_events) GROUP BY 1, 2", "msg_events")
plain("r20_habits", lambda s, d: stats.mine(A.msg_docs(s, d)).groupBy("contact_id").agg((F.count_if(F.col("text").contains("\n")) / F.count("*")).alias("newline_rate"), (F.count_if(F.length("text") <= 25) / F.count("*")).alias("short_share"), (F.count_if(F.hour("timestamp") < 4) / F.count("*")).alias("late_share")), "SELECT contact_id, round(count(*) FILTER (contains(text, chr(10))) / count(*)::DOUBLE, 6) AS newline_rate, round(count(*) FILTER (length(text) <= 25) / count(*)::DOUBLE, 6) AS short_share, round(count(*) FILTER (hour(make_timestamp(ms * 1000)) < 4) / count(*)::DOUBLE, 6) AS late_share FROM msg_docs GROUP BY 1", "msg_docs")
plain("r17_contact_index", lambda s, d: A.contacts(s, d).select("contact_id", "last_message_at").orderBy(F.desc("last_message_at"), "contact_id"), "SELECT contact_id, last_ms AS last_message_at FROM contacts", "contacts")
plain("g07_violations", lambda s, d: classify.violations(A.classified(s, d).withColumn("confidence", (F.col("seq") % 13) / 10.0).withColumn("label", F.when(F.col("seq") % 11 == 0, "enemy").otherwise(F.col("label")))), "SELECT contact_id, 'label' AS path, 'invalid_enum' AS code FROM classified WHERE seq % 11 = 0 UNION ALL SELECT contact_id, 'confidence', 'out_of_range' FROM classified WHERE seq % 13 > 10", "classified")

N = "contact_id::BIGINT"


def number():
    return F.col("contact_id").cast("long")


def shares(s: SparkSession, d: str) -> DataFrame:
    """Labelled contacts with the share of own messages."""
    c = A.contacts(s, d).select("contact_id", (F.col("message_count_from_me") / F.col("message_count_total")).alias("own"))
    return A.classified(s, d).select("contact_id", "label").join(c, "contact_id")


def word_counts(s: SparkSession, d: str) -> DataFrame:
    return A.msg_docs(s, d).where(has_text(F.col("text"))).select("contact_id", F.explode(tokens(F.col("text"))).alias("term")).groupBy("contact_id", "term").count()


def sections(s: SparkSession, d: str, new: bool) -> DataFrame:
    """A made-up section for each contact, old (numbers not divisible by 5) or new (not by 7)."""
    section = F.element_at(F.array(*map(F.lit, ("snapshot", "timeline", "corrections"))), (number() % 3 + 1).cast("int"))
    body = F.array(F.lit("a"), F.concat(F.lit("n" if new else "o"), "contact_id"))
    return A.contacts(s, d).where(number() % (7 if new else 5) != 0).select("contact_id", section.alias("section"), body.alias("body"))


WORDS = f"tt AS (SELECT contact_id, unnest({TOK}) AS term FROM msg_docs WHERE {HASTEXT}), cc AS (SELECT contact_id, term, count(*) AS n FROM tt GROUP BY 1, 2)"
plain("r07_register_shifts", lambda s, d: memory.register_shifts(shares(s, d), ["own"], 4), "SELECT label, count(*) AS contacts, round(avg(own) - any_value(g), 6) AS own_shift FROM (SELECT label, own, avg(own) OVER () AS g FROM (SELECT label, message_count_from_me / message_count_total::DOUBLE AS own FROM classified JOIN contacts USING (contact_id))) GROUP BY 1 HAVING count(*) >= 4", "contacts", "classified")
plain("r08_inside_jokes", lambda s, d: memory.inside_jokes(word_counts(s, d)), None)
ORACLES["r08_inside_jokes"] = f"WITH msg_docs AS ({SQL['msg_docs']}), {WORDS} SELECT arg_max(contact_id, n) AS contact_id, term, max(n) AS count FROM cc GROUP BY term HAVING max(n) >= 3 AND count(*) FILTER (n >= 2) = 1"
plain("r09_recurring", lambda s, d: memory.recurring(word_counts(s, d)), None)
ORACLES["r09_recurring"] = f"WITH msg_docs AS ({SQL['msg_docs']}), {WORDS} SELECT contact_id, term, n AS count FROM cc WHERE n >= 5"
plain("r09_open_threads", lambda s, d: memory.open_threads(A.contacts(s, d), F.lit("2024-04-29").cast("date")).select("contact_id"), "SELECT contact_id FROM contacts WHERE date_diff('day', make_timestamp(last_ms * 1000)::DATE, DATE '2024-04-29') BETWEEN 0 AND 90", "contacts")
plain("r09_last_messages", lambda s, d: memory.last_messages(A.msg_events(s, d)).select("contact_id", "seq"), "SELECT contact_id, seq FROM (SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY ms DESC, seq DESC) AS r FROM msg_events) WHERE r <= 50", "msg_events")
plain("r12_merge_sections", lambda s, d: memory.merge_sections(sections(s, d, False), sections(s, d, True)).select("contact_id", "section", F.array_join("body", "|").alias("body")), f"SELECT contact_id, s AS section, CASE WHEN a AND b THEN CASE s WHEN 'snapshot' THEN 'a|n' || contact_id WHEN 'timeline' THEN 'a|o' || contact_id || '|n' || contact_id ELSE 'a|o' || contact_id END WHEN a THEN 'a|o' || contact_id ELSE 'a|n' || contact_id END AS body FROM (SELECT contact_id, (['snapshot', 'timeline', 'corrections'])[{N} % 3 + 1] AS s, {N} % 5 <> 0 AS a, {N} % 7 <> 0 AS b FROM contacts) WHERE a OR b", "contacts")
plain("r13_roll_back", lambda s, d: memory.roll_back(A.classified(s, d).select("contact_id", "label", (number() % 4).alias("sensitivities")), A.classified(s, d).where(number() % 5 != 0).select("contact_id", F.when(number() % 2 == 0, "friend").otherwise(F.col("label")).alias("label"), (number() % 3).alias("sensitivities"))), f"SELECT round(c, 6) AS changed, round(g, 6) AS deleted, c > 0.3 OR g > 0.5 AS roll_back FROM (SELECT count(*) FILTER (k % 5 <> 0 AND k % 2 = 0 AND label <> 'friend') / greatest(count(*) FILTER (k % 5 <> 0), 1)::DOUBLE AS c, sum(greatest(k % 4 - CASE WHEN k % 5 <> 0 THEN k % 3 ELSE 0 END, 0)) / greatest(sum(k % 4), 1)::DOUBLE AS g FROM (SELECT label, {N} AS k FROM classified))", "classified")
plain("r14_confidence_drops", lambda s, d: memory.confidence_drops(A.contacts(s, d).select("contact_id", (number() % 10 / 10.0).alias("confidence")), A.contacts(s, d).select("contact_id", (number() % 7 / 10.0).alias("confidence"))), f"SELECT contact_id, round({N} % 10 / 10.0::DOUBLE, 6) AS before, round({N} % 7 / 10.0::DOUBLE, 6) AS after FROM contacts WHERE {N} % 10 - {N} % 7 > 1", "contacts")
plain("r15_archived", lambda s, d: memory.archived(A.classified(s, d), stats.passing(A.contacts(s, d), 65, 20)), "SELECT contact_id FROM classified WHERE contact_id NOT IN (SELECT contact_id FROM contacts WHERE message_count_total >= 65 AND message_count_from_me >= 20 AND message_count_from_them >= 20)", "contacts", "classified")
plain("r16_unique_slugs", lambda s, d: classify.unique_slugs(A.contacts(s, d).select("contact_id", F.concat(F.lit("user-"), (number() % 100).cast("string")).alias("slug"))), f"SELECT contact_id, slug || CASE WHEN count(*) OVER (PARTITION BY slug) > 1 THEN '-' || left(sha256(contact_id), 6) ELSE '' END AS slug FROM (SELECT contact_id, 'user-' || {N} % 100 AS slug FROM contacts)", "contacts")


def correction_source():
    return F.element_at(F.array(*map(F.lit, [*memory.CORRECTIONS, "elsewhere"])), (F.col("seq") % 13 + 1).cast("int"))


plain("r18_strongest", lambda s, d: memory.strongest(A.msg_events(s, d).select("contact_id", F.lit("tone").alias("field"), F.col("seq").cast("string").alias("value"), correction_source().alias("source"), "seq")), f"SELECT contact_id, 'tone' AS field, arg_min(seq, seq % 13 * 1000000000 - seq)::VARCHAR AS value, ({[*memory.CORRECTIONS, 'elsewhere']})[min(seq % 13) + 1] AS source FROM msg_events GROUP BY contact_id", "msg_events")
plain("r19_anchored_rate", lambda s, d: A.contacts(s, d).select("contact_id", memory.anchored_rate(F.col("message_count_from_me") / F.col("message_count_total")).alias("rate")), "SELECT contact_id, CASE WHEN r > 0 THEN '1 per ' || round(1 / r)::BIGINT || printf(' messages (%.1f%%)', round(r * 100, 1)) ELSE 'never (0.0%)' END AS rate FROM (SELECT contact_id, message_count_from_me / message_count_total::DOUBLE AS r FROM contacts)", "contacts")
plain("r21_too_long", lambda s, d: memory.too_long(A.msg_conv(s, d).select(F.col("seq").alias("id"), F.when(F.col("sender") == "me", "quote").otherwise("evidence").alias("kind"), "text")), "SELECT seq AS id, CASE WHEN sender = 'me' THEN 'quote' ELSE 'evidence' END AS kind, length(text) AS length FROM msg_conv WHERE length(text) > CASE WHEN sender = 'me' THEN 30 ELSE 60 END", "msg_conv")


def flat_plan(s: SparkSession, d: str) -> DataFrame:
    p = sampling.sample_plan(A.msg_docs(s, d))
    row = lambda x: F.concat_ws(" ", x["topic"], x["message_count"].cast("string"), x["match_count"].cast("string"), flat_terms(x["top_terms"]))
    return p.select("contact_id", "chars", "strategy", F.array_join(F.transform("topic_profile", row), ";").alias("profile"))


TOPIC_LIST = "[" + ", ".join(f"'{t}'" for t in sampling.TOPICS) + "]"
plain("m04_sample_plan", flat_plan, None)
ORACLES["m04_sample_plan"] = f"WITH msg_docs AS ({SQL['msg_docs']}){topic_sql()}, c AS (SELECT contact_id, sum({ln})::BIGINT AS chars FROM msg_docs GROUP BY 1), j AS (SELECT contact_id, string_agg(topic || ' ' || message_count || ' ' || match_count || ' ' || terms, ';' ORDER BY list_position({TOPIC_LIST}, topic)) AS profile FROM profile GROUP BY 1) SELECT contact_id, chars, CASE WHEN chars <= 30000 THEN 'full' ELSE 'topic_time_stratified' END AS strategy, profile FROM c JOIN j USING (contact_id)"
plain("m06_contact_sample", lambda s, d: sampling.contact_sample(A.msg_docs(s, d), 40), None)
ORACLES["m06_contact_sample"] = f"WITH msg_docs AS ({SQL['msg_docs']}), c AS (SELECT contact_id, sum({ln})::BIGINT AS chars FROM msg_docs GROUP BY 1), large AS (SELECT m.* FROM msg_docs m JOIN c USING (contact_id) WHERE chars > 30000 AND text IS NOT NULL), {topic_aware_sql('large', 40)} SELECT contact_id, seq FROM aware UNION ALL SELECT m.contact_id, m.seq FROM msg_docs m JOIN c USING (contact_id) WHERE chars <= 30000 AND text IS NOT NULL"
plain("m07_persona_sample", lambda s, d: sampling.persona_sample(A.msg_events_text(s, d), A.classified(s, d), 400), with_sql("", "classified") + f", msg AS ({SQL['msg_events_text']}), cl AS (SELECT * FROM classified WHERE label <> 'unclassified'), quota AS (SELECT contact_id, label, lq // c + (j < lq % c)::BIGINT AS quota FROM (SELECT contact_id, label, 400 // l + (i < 400 % l)::BIGINT AS lq, c, row_number() OVER (PARTITION BY label ORDER BY seq) - 1 AS j FROM cl JOIN (SELECT label, count(*) AS c, row_number() OVER (ORDER BY min(seq)) - 1 AS i, count(*) OVER () AS l FROM cl GROUP BY label) USING (label))), pool AS (SELECT m.contact_id, ms, m.seq, label, quota FROM msg m JOIN quota USING (contact_id) WHERE sender = 'me' AND text IS NOT NULL), {strata_sql('x', 'pool', 'quota', keep='label')} SELECT contact_id, seq, label FROM x WHERE t")
plain("r06_general_terms", lambda s, d: classify.general_terms(A.msg_docs(s, d).select(F.element_at(F.array(*map(F.lit, A.LABELS)), (F.col("seq") % 9 + 1).cast("int")).alias("label"), F.explode(tokens(F.col("text"))).alias("term"))), None)
ORACLES["r06_general_terms"] = f"WITH msg_docs AS ({SQL['msg_docs']}) SELECT term, count(DISTINCT l) AS labels FROM (SELECT seq % 9 AS l, unnest({TOK}) AS term FROM msg_docs) GROUP BY 1 HAVING count(DISTINCT l) >= 2"
plain("r10_chunks", lambda s, d: memory.chunks(A.msg_docs(s, d), 200), "SELECT contact_id, CASE WHEN n > 200 THEN h END AS half, count(*) AS messages, min(ms) AS first_at, max(ms) AS last_at FROM (SELECT *, (year(make_timestamp(ms * 1000)) * 2 + floor((month(make_timestamp(ms * 1000)) - 1) / 2.0 / 3))::BIGINT AS h, count(*) OVER (PARTITION BY contact_id) AS n FROM msg_docs) GROUP BY 1, 2", "msg_docs")


def made_up(s: SparkSession, d: str) -> DataFrame:
    """Findings of windows, made of events: kinds by number, items few."""
    kind = F.element_at(F.array(*map(F.lit, ("topic", "joke", "thread", "last_state"))), (F.col("seq") % 4 + 1).cast("int"))
    return A.msg_events(s, d).select("contact_id", (F.unix_millis("timestamp") % 3).alias("half"), kind.alias("kind"), (F.col("seq") % 5).cast("string").alias("item"), (F.col("seq") % 7).alias("count"), F.col("seq").alias("first_seen"), (F.col("seq") % 3).alias("severity"))


plain("r10_merge_windows", lambda s, d: memory.merge_windows(made_up(s, d)), "SELECT contact_id, kind, item, sum(c)::BIGINT AS count, min(seq) AS first_seen, max(seq % 3) AS severity FROM (SELECT contact_id, seq, (['topic', 'joke', 'thread', 'last_state'])[seq % 4 + 1] AS kind, (seq % 5)::VARCHAR AS item, seq % 7 AS c, ms % 3 AS half, max(ms % 3) OVER (PARTITION BY contact_id) AS last FROM msg_events) WHERE kind NOT IN ('thread', 'last_state') OR half = last GROUP BY 1, 2, 3", "msg_events")


def threads(s: SparkSession, d: str, new: bool) -> DataFrame:
    c = A.contacts(s, d).where(number() % (3 if new else 2) != 0)
    return c.select("contact_id", F.lit("trip").alias("thread"), F.lit("open" if new else "stalled").alias("status"), F.col("message_count_total" if new else "message_count_from_me").alias("last_seen"))


plain("r12_merge_threads", lambda s, d: memory.merge_threads(threads(s, d, False), threads(s, d, True)), f"SELECT contact_id, 'trip' AS thread, CASE WHEN {N} % 3 <> 0 THEN 'open' ELSE 'resolved or stale' END AS status, CASE WHEN {N} % 3 <> 0 THEN message_count_total ELSE message_count_from_me END AS last_seen FROM contacts WHERE {N} % 3 <> 0 OR {N} % 2 <> 0", "contacts")
