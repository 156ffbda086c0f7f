import json

import pytest

from chatterloom.sources import sessions

AT = 1_738_713_600


def put(path, name, doc):
    (path / name).write_text(json.dumps(doc, ensure_ascii=False))


def listed(kind="private"):
    return {
        "meta": {"name": "Lake club", "platform": "wechat", "type": kind, "groupId": "g7", "ownerId": "u1"},
        "members": [{"platformId": "u1", "accountName": "Ann"}, {"platformId": "u2", "accountName": "Bo", "groupNickname": "Bobby"}],
        "messages": [
            {"sender": "u1", "timestamp": AT, "type": 0, "content": "hello", "platformMessageId": "m1"},
            {"sender": "u2", "timestamp": (AT + 60) * 1000, "type": 1, "content": None, "platformMessageId": 12},
            {"sender": "u2", "timestamp": str(AT + 120), "type": 25, "content": "yes [引用 Ann：hello]", "replyToMessageId": "m1"},
            {"sender": "u2", "timestamp": AT + 180, "type": 80, "content": "joined"},
            {"sender": "u2", "timestamp": AT + 240, "type": 0, "content": 42, "replyToMessageId": "12"},
            {"sender": "u2", "timestamp": AT + 300, "type": 99, "content": "odd"},
            {"sender": "u2", "timestamp": AT + 360, "type": 0, "content": {"a": 1}},
        ],
    }


def talked(**more):
    return {
        "talker": "t5",
        "messages": [
            {"localId": 1, "serverId": "s1", "localType": 1, "createTime": AT, "isSend": 1, "content": "hi"},
            {"localId": 2, "localType": "3", "createTime": AT + 1, "isSend": False, "mediaType": "BigImage"},
            {"localId": 3, "localType": 244, "createTime": AT + 2, "senderUsername": "t5", "senderDisplayName": "Ann", "parsedContent": None, "content": "", "rawContent": "re", "replyToMessageId": "s1"},
            {"localId": 4, "localType": 10000, "createTime": AT + 3, "content": "notice"},
        ],
    } | more


def test_private_and_group(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    put(tmp_path, "a.json", listed())
    put(tmp_path / "sub", "b.JSON", listed("group"))
    got = sessions.messages(spark, str(tmp_path), "Ann").orderBy("timestamp", "seq").collect()
    assert [(r["contact_id"], r["contact_name"], r["sender"], r["text"], r["media_type"]) for r in got] == [("u2", "Bo", "me", "hello", "text"), ("u2", "Bo", "them", None, "image"), ("u2", "Bo", "them", "yes", "text"), ("u2", "Bo", "them", "42", "text"), ("u2", "Bo", "them", None, "text")]
    replies = [r["reply_to_timestamp"] and int(r["reply_to_timestamp"].timestamp()) for r in got]
    assert replies == [None, None, AT, AT + 60, None]
    assert {r["platform"] for r in got} == {"wechat"} and len({r["seq"] for r in got}) == 5
    assert sessions.messages(spark, str(tmp_path), "Ann", include_groups=True).count() == 10
    g = sessions.group_messages(spark, str(tmp_path), "Ann").orderBy("timestamp").collect()
    assert [(r["group_id"], r["group_name"], r["participant_name"], r["sender"]) for r in g[:2]] == [("g7", "Lake club", "Ann", "me"), ("g7", "Lake club", "Bobby", "participant")]


def test_talked(spark, tmp_path):
    put(tmp_path, "one.json", talked(displayName="Tia"))
    put(tmp_path, "two.json", talked(talker=None, session={"wxid": "w9", "remark": "Rem", "type": "群聊"}))
    got = sessions.messages(spark, str(tmp_path), "Ann").orderBy("timestamp").collect()
    assert [(r["contact_id"], r["contact_name"], r["sender"], r["text"], r["media_type"]) for r in got] == [("t5", "Tia", "me", "hi", "text"), ("t5", "Tia", "them", None, "image"), ("t5", "Tia", "me", "re", "text")]
    assert int(got[2]["reply_to_timestamp"].timestamp()) == AT
    g = sessions.group_messages(spark, str(tmp_path), "Ann").orderBy("timestamp").collect()
    assert [(r["group_id"], r["group_name"], r["participant_id"]) for r in g] == [("w9", "Rem", "me"), ("w9", "Rem", "unknown"), ("w9", "Rem", "t5")]


def test_errors(spark, tmp_path):
    put(tmp_path, "x.json", {"rows": []})
    with pytest.raises(Exception, match="neither shape"):
        sessions.messages(spark, str(tmp_path), "Ann").collect()
    bad = talked()
    bad["messages"][0]["createTime"] = "soon"
    put(tmp_path, "x.json", bad)
    with pytest.raises(Exception, match="invalid timestamp"):
        sessions.messages(spark, str(tmp_path), "Ann").collect()
