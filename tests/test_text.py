import random
import re

import pytest
from pyspark.sql import functions as F

from chatterloom.functions import text as T


def one(spark, f, *values):
    d = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in d.select(f(F.col("s"))).collect()]


def test_text_functions(spark):
    assert one(spark, T.fix_mojibake, "cafÃ©", "plain", "你好", "Ã", None) == ["café", "plain", "你好", "Ã", None]
    assert one(spark, T.strip_quote, "hey [引用 Bo：what]", "[引用 Bo: what]", "no quote", "[引用 open") == ["hey", None, "no quote", "[引用 open"]
    assert one(spark, T.utf16_length, "a😀", "") == [3, 0]
    assert one(spark, T.tokens, "What's v1.5 我们 99 30%") == [["what", "s", "v1.5", "我", "们"]]
    assert one(spark, T.swear_count, "Fuck this shitty 草莓 草", "class") == [3, 0]
    assert one(spark, lambda c: T.slugify(c, F.lit("Mx.Liu")), "Mei Lin") == ["mei-mxliu"]
    assert one(spark, T.result_file_name, "wxid/alex@example.com") == ["d3hpZC9hbGV4QGV4YW1wbGUuY29t.json"]
    assert one(spark, lambda c: T.redact(c, custom=[{"pattern": "a.b", "is_regex": False, "flags": "gi", "replacement": "$1"}]), "x A.B a.b axb") == ["x $1 $1 axb"]
    assert one(spark, lambda c: T.redact(c, custom=[{"pattern": "o", "is_regex": True, "flags": "", "replacement": "0"}]), "foo") == ["f0o"]


def test_slugs(spark):
    cases = [("Min Park", "min_p", "min-minp"), ("Riley Tanaka", None, "riley"), ("M.X. Liu", "mx-liu", "mx-mxliu"), ("李雷", "li", "-li"), ("\u3000 Jo Do", "", "jo"), ("李雷", None, ""), (None, "x", "-x")]
    d = spark.createDataFrame([(n, u) for n, u, _ in cases], "n string, u string")
    assert [r[0] for r in d.select(T.slugify(F.col("n"), F.col("u"))).collect()] == [x for *_, x in cases]


def test_redaction_guards(spark):
    """The same as all patterns searched everywhere."""
    rng = random.Random(2)
    parts = ["me@mail.example.com", ".x@y.org", "+61 412 345 678", "12 Long Hill Road.", "sk-" + "a" * 24, "AKIA1234567890ABCD", "ghp_" + "b" * 22, ".".join(["c" * 33] * 3), "-" + ".".join(["d" * 40] * 3) + "-", "word", "1", "@", "é", "_", ".", "\n", "x9"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "  "]) for _ in range(rng.randint(1, 8))) for _ in range(400)]

    def plainly(t):
        for p, new in [(T.EMAIL, "email"), (T.PHONE, "phone"), (T.ADDRESS, "address"), *((p, "secret") for p in T.SECRETS)]:
            t = re.sub(p, f"[redacted-{new}]", t, flags=re.ASCII)
        return t

    assert one(spark, T.redact, *texts) == [plainly(t) for t in texts]


def test_emoji_class():
    inside = re.compile("[" + re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: chr(int(m[1], 16)), T.EMOJI[1:-1]) + "]")
    assert all(inside.match(c) for c in "😀❤⚡☎♟🫠©⭐") and not any(inside.match(c) for c in "a1#我é🇦")
    assert T.EMOJI.count("-") < 200


def test_segmentation(spark):
    from itertools import product

    from chatterloom.functions.segment import Dictionary, segmented

    counts = {"北京": 50, "大学": 40, "北京大学": 60, "大学生": 30, "生活": 45, "学生": 35, "活": 3, "生": 5}
    d = Dictionary(counts)
    rng = random.Random(1)
    for _ in range(60):
        run = "".join(rng.choices("北京大学生活人", k=rng.randint(1, 8)))
        ways = []
        for cuts in product((0, 1), repeat=len(run) - 1):
            words, at = [], 0
            for i, c in enumerate((*cuts, 1), 1):
                if c:
                    words.append(run[at:i])
                    at = i
            if all(len(w) == 1 or w in counts for w in words):
                ways.append(sum(d.weight.get(w, d.alone) for w in words))
        got = d.cut(run)
        assert "".join(got) == run and sum(d.weight.get(w, d.alone) for w in got) == pytest.approx(max(ways))
    assert one(spark, lambda c: segmented(c, counts), "北京大学生活 OK v1.5 我", "Plain text 12", None) == [["北京大学", "生活", "ok", "v1.5", "我"], ["plain", "text"], None]
    assert one(spark, segmented, "我们开黑打排位") == [["我", "们", "开黑", "打", "排位"]]
    with pytest.raises(ValueError, match="more than tasks can hold"):
        Dictionary({"x" * 30_000_000: 1})
