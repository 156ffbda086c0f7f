import json

from chatterloom.sources import meta


def test_threads(spark, tmp_path):
    def put(folder, name, people, rows, **more):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(json.dumps({"participants": [{"name": p} for p in people], "messages": rows} | more))

    at = 1_700_000_000_000
    put("a_1", "message_1.json", ["Bo", "Me"], [
        {"sender_name": "Me", "timestamp_ms": at + 3, "content": "cafÃ©"},
        {"sender_name": "Bo", "timestamp_ms": at + 2, "photos": [{"uri": "x"}]},
        {"sender_name": "Bo", "timestamp_ms": at + 1, "content": "gone", "is_unsent": True},
        {"sender_name": "Bo", "timestamp_ms": at + 1, "content": "joined", "type": "Subscribe"},
        {"sender_name": "Bo", "timestamp_ms": at},
    ])
    put("a_1", "message_2.json", ["Bo", "Me"], [{"sender_name": "Bo", "timestamp_ms": at - 9, "content": "first"}])
    put("g_2", "message_1.json", ["Bo", "Al", "Me"], [{"sender_name": "Al B", "timestamp_ms": at, "content": "hi"}], title="Trip")
    rows = meta.messages(spark, [str(tmp_path)], "Me").orderBy("contact_id", "timestamp", "seq").collect()
    assert [(r["contact_id"], r["contact_name"], r["sender"], r["text"], r["media_type"]) for r in rows] == [("a_1", "Bo", "them", "first", "text"), ("a_1", "Bo", "them", None, "image"), ("a_1", "Bo", "me", "café", "text"), ("g_2", "Bo", "them", "hi", "text")]
    g = meta.group_messages(spark, [str(tmp_path)], "Me").collect()
    assert [(r["group_name"], r["participant_id"], r["sender"]) for r in g] == [("Trip", "al_b", "participant")]
