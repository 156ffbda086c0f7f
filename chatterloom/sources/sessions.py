"""Chats exported as one JSON document each, in two shapes: with `meta` and `members`, or with `talker` or `session`.

A file is read as one text (the format has no record borders), routed by the fields it holds, and exploded into rows;
members and replies are joined by (file, id), so that no message row carries the file's lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip_quote

LISTED = """meta struct<name:string,platform:string,type:string,groupId:string,ownerId:string>,
members array<struct<platformId:string,accountName:string,groupNickname:string>>,
messages array<struct<sender:string,accountName:string,groupNickname:string,timestamp:string,type:int,content:variant,platformMessageId:string,replyToMessageId:string>>"""
TALKED = """session struct<wxid:string,nickname:string,remark:string,displayName:string,type:string>, talker string, displayName string, sessionName string,
messages array<struct<localId:string,serverId:string,localType:string,createTime:string,isSend:string,senderUsername:string,senderDisplayName:string,content:variant,rawContent:variant,parsedContent:variant,replyToMessageId:string,mediaType:string>>"""
# Media by the type number of the first shape, and of the second; types that are system notices.
LISTED_MEDIA = {0: "text", 25: "text", 1: "image", 2: "voice", 3: "video", 4: "file", 5: "sticker", 7: "share", 24: "share", 26: "share", 27: "share", 23: "call"}
TALKED_MEDIA = {1: "text", 3: "image", 34: "voice", 43: "video", 47: "sticker", 49: "share", 50: "call"}
LISTED_NOTICES, TALKED_NOTICES = (80, 81), (10000, 10002)
# Words in a media type's name, in order.
MEDIA_WORDS = (("image", "image"), ("voice", "voice"), ("audio", "voice"), ("video", "video"), ("emoji", "sticker"), ("sticker", "sticker"), ("file", "file"), ("share", "share"), ("link", "share"), ("call", "call"))
GROUP_TYPE, GROUP_TAIL, PLATFORM = "群聊", "@chatroom", "wechat"


def documents(spark: SparkSession, path: str) -> DataFrame:
    """file, stem, value of every .json file (in any case) at or below path."""
    at = F.col("_metadata.file_path")
    d = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.[jJ][sS][oO][nN]").text(path).select(at.alias("file"), F.col("_metadata.file_name").alias("name"), "value")
    return d.select("file", F.regexp_replace("name", r"(?s)(?<=.)\.[^.]*\z", "").alias("stem"), "value")


def content_text(v: Column) -> Column:
    """Texts without their quotation, numbers and booleans as texts; objects, lists and empty texts are null."""
    kind = F.schema_of_variant(v)
    plain = F.try_variant_get(v, "$", "string")
    return F.when(kind == "STRING", strip_quote(plain)).when(kind.rlike("^(BIGINT|DOUBLE|DECIMAL|BOOLEAN|FLOAT)"), plain)


def epoch(c: Column) -> Column:
    """Seconds, or milliseconds above 1e10; anything else is an error."""
    n = c.try_cast("double")
    n = F.when(n.isNull() | F.isnan(n) | (F.abs(n) == float("inf")), F.raise_error(F.concat(F.lit("invalid timestamp: "), F.coalesce(c, F.lit("null")))).cast("double")).otherwise(n)
    return F.timestamp_millis(F.when(n > 1e10, n).otherwise(n * 1000).cast("long"))


def mine(keys: list[str], owner: Column, ident: Column, account: Column, nickname: Column) -> Column:
    """Whether a sender is the owner, or goes by one of my names."""
    named = [x.isin(keys) for x in (ident, account, nickname)] if keys else []
    c = F.coalesce((ident == owner) & (owner != ""), F.lit(False))
    for x in named:
        c = c | F.coalesce(x, F.lit(False))
    return c


def by_number(number: Column, table: dict[int, str]) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), number), F.lit("unknown"))


def routed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The documents of each shape. One that has neither is an error that names its file."""
    d = documents(spark, path).select("file", "stem", F.from_json("value", LISTED).alias("a"), F.from_json("value", TALKED).alias("b"))
    listed = F.coalesce(F.col("a.meta").isNotNull() & F.col("a.messages").isNotNull() & F.forall("a.messages", lambda m: m["sender"].isNotNull() & m["timestamp"].isNotNull() & m["type"].isNotNull()), F.lit(False))
    talked = F.coalesce(F.col("b.messages").isNotNull() & F.forall("b.messages", lambda m: m["createTime"].isNotNull()), F.lit(False))
    wrong = F.raise_error(F.concat(F.col("file"), F.lit(": neither shape of a chat export"))).cast("string")
    other = F.coalesce(F.col("a.meta.platform"), F.lit(""))
    alien = F.raise_error(F.concat(F.col("file"), F.lit(": not of this platform: "), other)).cast("string")
    d = d.withColumn("shape", F.when(listed & ~other.isin("", PLATFORM), alien).when(listed, "listed").when(talked, "talked").otherwise(wrong))
    return d.where("shape = 'listed'").select("file", "stem", "a.*"), d.where("shape = 'talked'").select("file", "stem", "b.*")


def with_replies(d: DataFrame) -> DataFrame:
    """Adds reply_to_timestamp: the time of the last message of the file whose ident is reply."""
    ids = d.where(F.length("ident") > 0).groupBy("file", F.col("ident").alias("__key")).agg(F.max_by("timestamp", "pos").alias("reply_to_timestamp"))
    key = F.coalesce(F.nullif("reply", F.lit("")), F.concat(F.lit("\0"), F.col("pos")))  # rows without a reply: spread
    return d.withColumn("__key", key).join(ids, ["file", "__key"], "left").drop("__key")


def listed_rows(d: DataFrame, keys: list[str]) -> DataFrame:
    members = F.coalesce("members", F.expr("cast(array() as array<struct<platformId:string,accountName:string,groupNickname:string>>)"))
    owner = F.col("meta.ownerId")
    d = d.withColumn("members", members)
    who = F.get(F.filter("members", lambda m: ~mine(keys, owner, m["platformId"], m["accountName"], m["groupNickname"])), F.lit(0))
    said = F.get(F.filter("messages", lambda m: ~mine(keys, owner, m["sender"], m["accountName"], m["groupNickname"])), F.lit(0))
    grouped = F.coalesce(F.col("meta.type") == "group", F.lit(False))
    d = d.withColumn("grouped", grouped).withColumn("o", who).withColumn("s", said)
    d = d.withColumn("chat_id", F.when(F.col("grouped"), F.coalesce("meta.groupId", "stem")).otherwise(F.coalesce("o.platformId", "s.sender", "meta.groupId", "stem")))
    private = F.coalesce("o.accountName", "o.groupNickname", "s.accountName", "s.groupNickname", "meta.name", "chat_id")
    d = d.withColumn("chat_name", F.when(F.col("grouped"), F.coalesce("meta.name", "chat_id")).otherwise(private))
    m = d.select("file", F.posexplode("members").alias("mpos", "x")).where(F.length("x.platformId") > 0)
    m = m.groupBy("file", F.col("x.platformId").alias("who")).agg(F.max_by("x.accountName", "mpos").alias("maccount"), F.max_by("x.groupNickname", "mpos").alias("mnick"))
    r = d.select("file", "grouped", "chat_id", "chat_name", owner.alias("owner"), F.posexplode("messages").alias("pos", "m"))
    r = r.select("*", F.col("m.sender").alias("who"), epoch(F.col("m.timestamp")).alias("timestamp"), F.col("m.platformMessageId").alias("ident"), F.col("m.replyToMessageId").alias("reply"))
    r = with_replies(r).where(~F.col("m.type").isin(*LISTED_NOTICES)).join(m, ["file", "who"], "left")
    account, nick = F.coalesce("m.accountName", "maccount"), F.coalesce("m.groupNickname", "mnick")
    shown = F.coalesce("m.groupNickname", "mnick", "m.accountName", "maccount", "who")
    text = F.when(F.col("m.type").isin(0, 25), content_text(F.col("m.content")))
    return r.select("file", "pos", "grouped", "chat_id", "chat_name", "timestamp", mine(keys, F.col("owner"), F.col("who"), account, nick).alias("mine"), F.col("who").alias("participant_id"), shown.alias("participant_name"), text.alias("text"), by_number(F.col("m.type"), LISTED_MEDIA).alias("media_type"), "reply_to_timestamp")


def talked_rows(d: DataFrame, keys: list[str]) -> DataFrame:
    d = d.withColumn("chat_id", F.coalesce("talker", "session.wxid", "stem"))
    d = d.withColumn("grouped", F.coalesce(F.col("session.type") == GROUP_TYPE, F.lit(False)) | F.endswith("chat_id", F.lit(GROUP_TAIL)))
    d = d.withColumn("chat_name", F.coalesce("displayName", "sessionName", "session.displayName", "session.remark", "session.nickname", "chat_id"))
    r = d.select("file", "grouped", "chat_id", "chat_name", F.posexplode("messages").alias("pos", "m"))
    kind, reply = F.col("m.localType").try_cast("double").cast("int"), F.col("m.replyToMessageId")
    r = r.select("*", kind.alias("kind"), reply.alias("reply"), F.coalesce("m.serverId", "m.localId").alias("ident"), epoch(F.col("m.createTime")).alias("timestamp"))
    r = with_replies(r).where(~F.coalesce(F.col("kind").isin(*TALKED_NOTICES), F.lit(False)))
    worded = F.coalesce(F.col("kind") == 1, F.lit(False)) | F.col("reply").isNotNull()
    name = F.lower("m.mediaType")
    media = F.when(F.length(name) > 0, _worded_media(name)).when(worded, "text").otherwise(by_number(F.col("kind"), TALKED_MEDIA))
    text = F.when(worded, F.coalesce(*[content_text(F.col(f"m.{c}")) for c in ("parsedContent", "content", "rawContent")]))
    me = F.when(F.col("m.isSend").isNotNull(), F.col("m.isSend").isin("1", "true")).otherwise(mine(keys, F.lit(None).cast("string"), F.col("m.senderUsername"), F.col("m.senderDisplayName"), F.lit(None).cast("string")))
    r = r.withColumn("mine", me).withColumn("participant_id", F.coalesce("m.senderUsername", F.when(F.col("mine"), "me").otherwise("unknown")))
    return r.select("file", "pos", "grouped", "chat_id", "chat_name", "timestamp", "mine", "participant_id", F.coalesce("m.senderDisplayName", "participant_id").alias("participant_name"), text.alias("text"), media.alias("media_type"), "reply_to_timestamp")


def _worded_media(name: Column) -> Column:
    c = F.when(F.lit(False), "")
    for word, medium in MEDIA_WORDS:
        c = c.when(name.contains(word), medium)
    return c.otherwise("unknown")


def rows(spark: SparkSession, path: str, me: str, aliases: list[str] = ()) -> DataFrame:
    keys = sorted({x.strip() for x in (me, *aliases) if x and x.strip()})
    a, b = routed(spark, path)
    d = listed_rows(a, keys).unionByName(talked_rows(b, keys))
    return d.where((F.col("media_type") != "unknown") | F.col("text").isNotNull()).withColumn("seq", F.shiftleft(F.hash("file").cast("long"), 32) + F.col("pos"))


def messages(spark: SparkSession, path: str, me: str, aliases: list[str] = (), include_groups: bool = False) -> DataFrame:
    """Messages of private chats (and of groups, if asked for). Order by contact_id, timestamp, seq."""
    d = rows(spark, path, me, aliases)
    d = d if include_groups else d.where(~F.col("grouped"))
    return d.select(F.col("chat_id").alias("contact_id"), F.col("chat_name").alias("contact_name"), "timestamp", F.when(F.col("mine"), "me").otherwise("them").alias("sender"), "text", "media_type", "reply_to_timestamp", F.lit(PLATFORM).alias("platform"), "seq")


def group_messages(spark: SparkSession, path: str, me: str, aliases: list[str] = ()) -> DataFrame:
    """Messages of groups alone."""
    d = rows(spark, path, me, aliases).where("grouped")
    return d.select(F.col("chat_id").alias("group_id"), F.col("chat_name").alias("group_name"), "timestamp", F.when(F.col("mine"), "me").otherwise("participant").alias("sender"), "participant_id", "participant_name", "text", "media_type", "reply_to_timestamp", F.lit(PLATFORM).alias("platform"), "seq")
