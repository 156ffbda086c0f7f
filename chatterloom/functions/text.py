"""Text expressions with the semantics of the message formats: UTF-16 lengths, wide white space, ASCII word edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that trimming removes, for Java and RE2 classes.
WS = r"[\t-\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
#: Edges beside which the pattern has an ASCII word character.
BEFORE_WORD, AFTER_WORD = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
#: The same characters themselves.
WIDE_SPACES = "\t\n\x0b\x0c\r \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
HAN = r"[\x{4E00}-\x{9FFF}]"
TOKEN = r"[\x{4E00}-\x{9FFF}]|[A-Za-z0-9]+(?:\.[0-9]+)?%?"

# The swear words counted (the last pattern counts substrings).
SWEARS = [
    "fuck(?:ing|ed|er|s)?",
    "shit(?:ty|s)?",
    "damn(?:ed)?",
    "bitch(?:es|ing|y)?",
    "ass(?:hole|holes)?",
    "cunt",
    "bastard",
]
SWEARS_HAN = "操|草(?!莓)|卧槽|妈的|靠|尼玛|傻逼|垃圾"
# What is redacted, in this order.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE = r"(\+?\d[\d\s\-().]{7,}\d)"
ADDRESS = r"(?i)\b\d{1,5}\s+[A-Za-z][A-Za-z\s]{2,40}(Road|Rd|Street|St|Avenue|Ave|Lane|Ln|Drive|Dr|Boulevard|Blvd|Crescent|Place|Pl|Way|Court|Ct|Highway|Hwy)\b\.?"
SECRETS = [
    r"\bsk-[A-Za-z0-9]{20,}\b",
    r"\bAKIA[0-9A-Z]{12,}\b",
    r"\bghp_[A-Za-z0-9]{20,}\b",
    r"\b[A-Za-z0-9_-]{32,}\.[A-Za-z0-9_-]{32,}\.[A-Za-z0-9_-]{32,}\b",
]
#: What a match of each secret begins with; the last begins anywhere, but takes two long runs.
SECRET_SIGNS = ["sk-", "AKIA", "ghp_", ""]
LONG_RUNS = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{32,}+\.[A-Za-z0-9_-]{32}"


def property_class(name: str) -> str:
    """The characters of a Unicode property as a class of ranges, for Java and RE2."""
    import regex

    have = regex.compile(rf"\p{{{name}}}+")
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x20000))))
    return "[" + "".join(rf"\x{{{ord(m[0][0]):X}}}-\x{{{ord(m[0][-1]):X}}}" for m in have.finditer(every)) + "]"


EMOJI = property_class("Extended_Pictographic")
#: What is none of them, but for a few: cut out before a text is searched for the class, whose many ranges are slow.
NO_EMOJI = r"[^\x{A9}\x{AE}\x{203C}-\x{1FFFF}]+"


def ascii_edges(pattern: str) -> str:
    """pattern (which begins and ends with ASCII word characters) where no such character is beside it."""
    return rf"(?<![A-Za-z0-9_])(?:{pattern})(?![A-Za-z0-9_])"


def ascii_pattern(pattern: str) -> str:
    return pattern.replace(r"\b", r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))")


def utf16_length(c: Column) -> Column:
    return (F.length(F.encode(c, "UTF-16BE")) / 2).cast("long")


def right_trim(c: Column) -> Column:
    return F.rtrim(c, F.lit(WIDE_SPACES))


def has_text(c: Column) -> Column:
    return F.coalesce(F.length(c) > 0, F.lit(False))


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("long")


def detect_lang(c: Column) -> Column:
    return F.when(c.rlike(HAN), "zh").when(c.rlike("[A-Za-z]"), "en").otherwise("other")


def tokens(c: Column) -> Column:
    """Runs of ASCII letters and digits that hold a letter, in lower case, and Han characters one by one.

    Segmentation of Han text by a dictionary can be put in its place by a caller; none is part of this library."""
    return F.transform(F.filter(F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0)), lambda t: (F.lower(t) != F.upper(t)) | is_han(t)), F.lower)


def is_han(token: Column) -> Column:
    """Whether a token is of Han characters: tokens of ASCII sort before them. Cheaper than a search."""
    return token >= F.lit("\u4e00")


def ngrams(words: Column, n: int) -> Column:
    """Adjacent tokens; those of Han alone are joined without a space."""
    def one(i: Column) -> Column:
        part = F.slice(words, i, n)
        return F.when(F.forall(part, is_han), F.array_join(part, "")).otherwise(F.array_join(part, " "))

    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), one)).otherwise(F.expr("cast(array() as array<string>)"))


def swear_count(c: Column) -> Column:
    """Whole words, which cannot overlap, by one alternation; the others only in texts that hold Han characters."""
    return count_of(c, "(?i)" + ascii_edges("|".join(SWEARS))) + F.when(c.rlike(HAN), count_of(c, SWEARS_HAN)).otherwise(0)


def pictographs(c: Column) -> Column:
    """Those of a text, in their order."""
    return F.regexp_extract_all(F.regexp_replace(c, NO_EMOJI, ""), F.lit(EMOJI), F.lit(0))


def letters(c: Column, which: str) -> Column:
    """How many characters of `which` a text holds."""
    return (F.length(c) - F.length(F.translate(c, which, ""))).cast("long")


def redact(c: Column, email: bool = True, phone: bool = True, address: bool = True, secrets: bool = True, custom: list[dict] | None = None) -> Column:
    """Replaces e-mails, phone numbers, addresses, secrets and custom patterns, in that order. A custom pattern:
    pattern, is_regex, flags (g: all matches, i: any case), replacement."""

    def put(c: Column, sign: Column, pattern: str, new: str) -> Column:
        """Texts without a cheap sign of a match are not searched."""
        return F.when(sign, F.regexp_replace(c, pattern, new)).otherwise(c)

    digits = F.length(c) - F.length(F.translate(c, "0123456789", ""))
    if email:
        c = put(c, c.contains("@"), ascii_pattern(EMAIL.removesuffix(r"\b")) + AFTER_WORD, "[redacted-email]")
    if phone:
        c = put(c, digits >= 2, PHONE, "[redacted-phone]")
    if address:
        c = put(c, digits >= 1, ADDRESS.replace(r"\b\.?", AFTER_WORD + r"\.?").replace(r"\b", BEFORE_WORD), "[redacted-address]")
    for p, sign in zip(SECRETS, SECRET_SIGNS) if secrets else ():
        edges = p.replace(r"\b", BEFORE_WORD, 1).replace(r"\b", AFTER_WORD) if sign else ascii_pattern(p)
        c = put(c, c.contains(sign) if sign else c.rlike(LONG_RUNS), edges, "[redacted-secret]")
    for p in custom or ():
        flags = p.get("flags", "gi") or ("" if p.get("is_regex") else "gi")
        body = p["pattern"] if p.get("is_regex") else "".join("\\" + x if x in r".*+?^${}()|[]\\" else x for x in p["pattern"])
        body = ("(?iu)" if "i" in flags else "") + body
        new = p.get("replacement", "[redacted-custom]").replace("\\", "\\\\").replace("$", "\\$")
        c = F.regexp_replace(c, body, new) if "g" in flags else F.regexp_replace(c, rf"(?s)\A(.*?)(?:{body})", "$1" + new)
    return c


def fix_mojibake(c: Column) -> Column:
    """Text whose characters are all below U+0100 is read again as UTF-8, if it is valid."""
    return F.when(c.rlike(r"^[\x00-\xFF]*$"), F.coalesce(F.try_validate_utf8(F.encode(c, "ISO-8859-1").cast("string")), c)).otherwise(c)


def strip_quote(c: Column) -> Column:
    """Text before a closing quotation mark-up of the form [引用 name: text]; null if nothing is left."""
    tail = F.rtrim(F.substring_index(c, "[引用", -1))
    quoted = c.contains("[引用") & tail.endswith("]") & (tail.contains(":") | tail.contains("："))
    kept = F.substring(c, F.lit(1), F.length(c) - F.length(F.substring_index(c, "[引用", -1)) - 3)
    return F.nullif(F.when(quoted, right_trim(kept)).otherwise(c), F.lit(""))


def slug(c: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", ""), F.lit("")), F.lit("unknown"))


def slugify(name: Column, username: Column) -> Column:
    """First word of a name and the user name, both of a-z and 0-9, joined by a hyphen if there is a user name (also
    where nothing is left of the first word)."""
    words = F.split(F.regexp_replace(F.coalesce(name, F.lit("")), "^" + WS + "+", ""), WS + "+")
    first = F.regexp_replace(F.lower(F.element_at(words, 1)), "[^a-z0-9]", "")
    user = F.regexp_replace(F.lower(F.coalesce(username, F.lit(""))), "[^a-z0-9]", "")
    return F.when(user != "", F.concat(first, F.lit("-"), user)).otherwise(first)


def result_file_name(contact_id: Column) -> Column:
    return F.concat(F.rtrim(F.translate(F.base64(F.encode(contact_id, "UTF-8")), "+/", "-_"), F.lit("=")), F.lit(".json"))


def normal_identity(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), WS + "+", "")
