"""What small JSON documents must hold. A check gives a list of (path, code, message); documents are read by the driver.

Tables of any size are checked by `classify.violations` instead."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime
from typing import Any

from .classify import LABELS
from .governance import PLATFORMS

Issue = tuple[str, str, str]
Check = Callable[[Any, str], Iterator[Issue]]


def text(least: int = 0, most: int | None = None) -> Check:
    def check(v, at):
        if not isinstance(v, str):
            yield at, "invalid_type", "text is expected"
        elif len(v) < least:
            yield at, "too_small", f"{least} characters at least"
        elif most is not None and len(v) > most:
            yield at, "too_big", f"{most} characters at most"

    return check


def number(low: float | None = None, high: float | None = None, whole: bool = False) -> Check:
    def check(v, at):
        if isinstance(v, bool) or not isinstance(v, int | float) or whole and v != int(v):
            yield at, "invalid_type", "a whole number is expected" if whole else "a number is expected"
        elif low is not None and v < low:
            yield at, "too_small", f"{low} at least"
        elif high is not None and v > high:
            yield at, "too_big", f"{high} at most"

    return check


def one_of(*values: str) -> Check:
    def check(v, at):
        if v not in values:
            yield at, "invalid_enum_value", "one of " + ", ".join(values)

    return check


def when(v, at):
    """A date: a number of milliseconds or a text in ISO form."""
    try:
        ok = isinstance(v, int | float) and not isinstance(v, bool) or bool(datetime.fromisoformat(v))
    except (TypeError, ValueError):
        ok = False
    if not ok:
        yield at, "invalid_date", "a date is expected"


def flag(v, at):
    if not isinstance(v, bool):
        yield at, "invalid_type", "true or false is expected"


def or_null(inner: Check) -> Check:
    return lambda v, at: iter(()) if v is None else inner(v, at)


def below(at: str, k: object) -> str:
    return f"{at}.{k}" if at else str(k)


def list_of(inner: Check, least: int = 0, most: int | None = None) -> Check:
    def check(v, at):
        if not isinstance(v, list):
            yield at, "invalid_type", "a list is expected"
            return
        if len(v) < least:
            yield at, "too_small", f"{least} items at least"
        if most is not None and len(v) > most:
            yield at, "too_big", f"{most} items at most"
        for k, x in enumerate(v):
            yield from inner(x, below(at, k))

    return check


def tuple_of(*inner: Check) -> Check:
    def check(v, at):
        yield from list_of(lambda *_: iter(()), len(inner), len(inner))(v, at)
        if isinstance(v, list):
            for k, (x, f) in enumerate(zip(v, inner)):
                yield from f(x, below(at, k))

    return check


def map_of(key: Check, inner: Check) -> Check:
    def check(v, at):
        if not isinstance(v, dict):
            yield at, "invalid_type", "an object is expected"
            return
        for k, x in v.items():
            yield from key(k, below(at, k))
            yield from inner(x, below(at, k))

    return check


def fields(optional: dict[str, Check] | None = None, **needed: Check) -> Check:
    """An object. Other fields may be there; optional ones are checked where they are."""

    def check(v, at):
        if not isinstance(v, dict):
            yield at, "invalid_type", "an object is expected"
            return
        for k, f in needed.items():
            if k not in v:
                yield below(at, k), "invalid_type", "required"
            else:
                yield from f(v[k], below(at, k))
        for k, f in (optional or {}).items():
            if k in v:
                yield from f(v[k], below(at, k))

    check.needed, check.optional = needed, optional or {}
    return check


count = number(0, whole=True)
positive = number(1, whole=True)
share = number(0, 1)
label = one_of(*LABELS)

# Fields and words of the documents' formats.
finding = fields(
    claim=text(1),
    anchor=fields(count=count, rate=text(), denominator=positive),
    examples=list_of(text(most=30), most=3),
    generalizes=flag,
    register_locked=or_null(label),
)
shifts = fields(lexicon_shift=text(), punctuation_shift=text(), emoji_shift=text(), length_shift=text(), swear_shift=text(), n_contacts=positive)
persona_findings = fields(
    generated_at=text(),
    source_stats_path=text(),
    categories=fields(**{k: list_of(finding) for k in ("lexical_fingerprint", "punctuation_and_caps", "emoji", "message_structure", "conversational_moves", "hard_donts")}),
    register_table=map_of(label, shifts),
)
address_term = fields({"first_seen": or_null(text())}, term=text(1), count=count, registers=list_of(text()))
memory_findings = fields(
    contact_id=text(),
    slug=text(),
    generated_at=text(),
    source_stats_path=text(),
    address_terms=fields(from_me_to_them=list_of(address_term), from_them_to_me=list_of(address_term), switch_signals=list_of(text())),
    timeline_events=list_of(fields({"evidence": text(most=80)}, date=text(), event=text(1))),
    recurring_topics=list_of(fields(topic=text(1), count=count, register=text(), last_mentioned=text())),
    inside_jokes=list_of(fields(phrase=text(1), first_seen=text(), count_with_them=count, count_with_others=count, context=text())),
    ongoing_threads=list_of(fields({"position_unknown": flag, "evidence_quote": text(most=30)}, thread=text(1), last_message=text(), status=one_of("open", "stalled"), user_position=or_null(text()), their_position=or_null(text()))),
    communication_rhythm=fields(typical_active_hours=text(), weekly_pattern=text(), median_reply_latency_from_me_seconds=number(0), median_reply_latency_from_them_seconds=number(0), burst_pattern=text(), preferred_register=one_of("relaxed", "conservative")),
    sensitivities=list_of(fields({"evidence_quotes": list_of(text(most=30), most=3)}, topic=text(1), severity=one_of("low", "medium", "high"), rationale=text(), last_triggered_at=or_null(text()))),
    conflict_patterns=list_of(fields({"resolution_pattern": text()}, pattern=text(1), frequency=text())),
    last_state_summary=fields(covering_messages=positive, date_range=tuple_of(text(), text()), summary=text(1)),
)
contact = dict(contact_id=text(), contact_name=text(), username=or_null(text()), message_count_total=count, message_count_from_me=count, message_count_from_them=count, first_message_at=when, last_message_at=when, span_days=count)
classified_contact = fields(
    {
        "label_source_note": or_null(text()),
        "context_tags": list_of(one_of("gaming", "work", "tech", "school", "family", "logistics", "personal_life", "group_chat")),
        "register_tags": list_of(one_of("gaming_banter", "profanity_ok", "casual_banter", "formal", "affectionate", "vulnerable", "practical_logistics")),
    },
    **contact,
    label=label,
    confidence=share,
    label_source=one_of("classifier", "manual_override", "correction_override"),
    signals=list_of(fields(type=text(), evidence=text(), weight=one_of("strong", "medium", "weak"))),
    alt_labels=list_of(fields(label=label, confidence=share)),
)
pattern = fields({"is_regex": flag, "flags": text(), "replacement": text(), "source": text()}, pattern=text(1), added_at=text())
config = fields(
    {
        "my_aliases": list_of(text()),
        "contact_threshold_total": positive,
        "contact_threshold_each_way": positive,
        "time_window": fields(**{"from": or_null(when), "to": or_null(when)}),
        "redaction": fields({"phone": flag, "email": flag, "address": flag, "secrets": flag, "custom_patterns": list_of(pattern)}),
        "manual_hints": map_of(text(), text()),
    },
    platform=one_of(*PLATFORMS),
    export_path=text(),
    my_name=text(),
)
pairs = list_of(tuple_of(text(), number()))
bundle = fields(
    lexical=fields(total_tokens=count, unique_tokens=count, top_words=pairs, top_bigrams=pairs, signature_phrases=pairs, swear_count=count, swear_rate_per_1k_messages=number(), language_mix=fields(en_ratio=number(), zh_ratio=number(), other_ratio=number()), code_switch_rate_per_msg=number()),
    punctuation=fields(ending_punctuation=map_of(text(), number()), caps_rate=number(), ellipsis_rate=number(), question_rate=number(), exclamation_rate=number(), comma_rate=number(), no_terminal_rate=number()),
    emoji=fields(top_emojis=pairs, total_emoji_count=count, emojis_per_message=number(), messages_with_emoji_ratio=number()),
    structure=fields(message_length_histogram=map_of(text(), number()), median_length_chars=number(), mean_length_chars=number(), p90_length_chars=number(), burst=fields(avg_messages_per_burst=number(), avg_gap_within_burst_seconds=number(), avg_gap_between_bursts_seconds=number())),
    timing=fields(hour_histogram=list_of(number(), 24, 24), weekday_histogram=list_of(number(), 7, 7), median_reply_latency_seconds=number()),
)
counted_terms = list_of(fields(term=text(), count=count))
group_context = fields(
    group_id=text(),
    group_name=text(),
    platform=one_of(*PLATFORMS),
    message_count=count,
    message_count_from_me=count,
    participant_count=count,
    first_message_at=when,
    last_message_at=when,
    top_participants=list_of(fields(participant_id=text(), participant_name=text(), message_count=count)),
    top_terms_from_me=counted_terms,
    top_terms_all=counted_terms,
)
signal = fields(
    contact_id=text(),
    contact_name=text(),
    matched_participant_ids=list_of(text()),
    matched_participant_names=list_of(text()),
    shared_groups=count,
    group_message_count_from_me=count,
    group_message_count_from_participant=count,
    address_terms_from_me=counted_terms,
    evidence_source=one_of("group_chat"),
    weight=one_of("weak"),
)

SCHEMAS: dict[str, Check] = {
    "persona_findings": persona_findings,
    "memory_findings": memory_findings,
    "classified_contact": classified_contact,
    "classified_contacts": list_of(classified_contact),
    "config": config,
    "global_stats": fields(generated_at=when, total_messages=count, total_messages_from_me=count, total_contacts=count, contacts_above_threshold=count, stats=bundle),
    "per_contact_stats": list_of(fields(contact_id=text(), contact_name=text(), message_count=count, stats=bundle)),
    "group_tone_stats": fields(generated_at=when, source_messages_path=text(), total_group_messages=count, total_messages_from_me=count, total_groups=count, stats=bundle),
    "group_relationship_signals": list_of(signal),
    "group_contexts": fields(generated_at=when, source_messages_path=text(), groups=list_of(group_context)),
}


def issues(schema: str, value: Any) -> list[Issue]:
    """What is wrong with a document, in the order of its parts; empty if nothing is."""
    return list(SCHEMAS[schema](value, ""))
