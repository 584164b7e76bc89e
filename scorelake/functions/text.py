"""Parsing of play texts, clocks, names and team labels with built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Beginnings of play texts and their event types, in order of precedence.
EVENT_PREFIXES = {
    "GOAL by": "GOAL",
    "Shot by": "SHOT",
    "Turnover by": "TURNOVER",
    "Faceoff": "FACEOFF",
    "Ground ball": "GROUND_BALL",
    "Penalty on": "PENALTY",
    "Clear attempt by": "CLEAR",
    "Timeout by": "TIMEOUT",
}
#: Fragments that tell the event type where no beginning does.
EVENT_FRAGMENTS = {"at goalie for": "GOALIE_CHANGE", "End-of-period": "PERIOD_END"}
#: Endings of shot texts and their results.
SHOT_ENDINGS = {"WIDE": "WIDE", "HIGH": "HIGH", "HIT POST": "POST", "HIT CROSSBAR": "CROSSBAR", "BLOCKED": "BLOCKED"}
#: What stands between the beginning of a text and the label of its team, by event type.
LABEL_AFTER = {
    "GOAL": "GOAL by ",
    "SHOT": "Shot by ",
    "TURNOVER": "Turnover by ",
    "FACEOFF": r"Faceoff\s+.+?\s+vs\s+.+?\s+won by\s+",
    "GROUND_BALL": "Ground ball pickup by ",
    "PENALTY": "Penalty on ",
    "CLEAR": "Clear attempt by ",
    "TIMEOUT": "Timeout by ",
    "GOALIE_CHANGE": ".*?at goalie for ",
}
#: Labels that end by the grammar of their text; of other events only the first word is sure to be of the label.
WHOLE_LABELS = {"FACEOFF": r"^([^,(]+)", "CLEAR": r"^(.+?)\s+(?:good|failed)\b", "TIMEOUT": r"^(.+?)\.?$", "GOALIE_CHANGE": r"^(.+?)\.?$"}
#: What ends the name of the player behind the label, besides a closing stop.
PLAYER_ENDS = {
    "GOAL": (r",\s*Assist by", r"\s*\([^)]+\)", r",\s*goal number"),
    "SHOT": (r",\s*SAVE", r",\s*TEAM SAVE", *(rf"\s+{k}" for k in SHOT_ENDINGS)),
    "TURNOVER": (r"\s*\([^)]+\)",),
    "GROUND_BALL": (),
}
#: Phrases of play texts that name further players or tell details.
GOALIE_FOR = r"^(.+?)\s+at goalie for "
ASSISTED, ASSIST = ", Assist by ", r",\s*Assist by (.+?)(?:,\s*goal number|$)"
SAVED, SAVE = ", SAVE ", r",\s*SAVE\s+(?:by\s+)?(.+?)\.?$"
CAUSED, CAUSED_BY = "(caused by ", r"\(caused by ([^)]+)\)"
FACEOFF_FIRST, FACEOFF_SECOND = r"^Faceoff\s+(.+?)\s+vs\s+", r"\s+vs\s+(.+?)\s+won by\s+"
PICKED_UP, FACEOFF_PICKUP = "Ground ball pickup by ", "^Faceoff.*Ground ball pickup by (.+)$"
VIOLATION, EXTRA_MAN, CLEARED = "on faceoff violation", "Extra-man opportunity", " good"
PENALTY_TERM = r"\(([^/]+)/(\d+):(\d+)\)"
#: Endings of a person's name, and names that are no person.
NAME_ENDINGS = ("JR", "JR.", "SR", "SR.", "II", "III", "IV", "V")
NO_PERSON = ("TEAM", "TM", "BENCH")


def chain(cases: list[tuple[Column, Column]], default: Column | None = None) -> Column:
    """The value of the first case that holds."""
    (first, value), *rest = cases
    out = reduce(lambda c, x: c.when(*x), rest, F.when(first, value))
    return out if default is None else out.otherwise(default)


def event_type(text: Column) -> Column:
    """Event type of a play text; beginnings and fragments are case-sensitive."""
    starts = [(text.startswith(k), F.lit(v)) for k, v in EVENT_PREFIXES.items()]
    parts = [(text.contains(k), F.lit(v)) for k, v in EVENT_FRAGMENTS.items()]
    return chain(starts + parts, F.lit("UNKNOWN"))


def from_label(text: Column) -> Column:
    """The text from the label of its team on; null where no label is told."""
    return found(text, f"^(?:{'|'.join(LABEL_AFTER.values())})(.+)$")


def spoken_label(kind: Column, rest: Column) -> Column:
    """The label, or its first word, at the beginning of rest (from_label), told without knowing any team; empty or null without one."""
    return chain([(kind == k, part(rest, pattern)) for k, pattern in WHOLE_LABELS.items()], part(rest, r"^(\S+)"))


def player_behind(kind: Column, tail: Column) -> Column:
    """The player in what follows a label, as written; empty or null without one."""
    ends = {k: part(tail, rf"^\s+(.+?)(?:{'|'.join((*stops, r'\.?$'))})") for k, stops in PLAYER_ENDS.items()}
    return chain([(kind == k, v) for k, v in ends.items()] + [(kind == "PENALTY", part(tail, r"^\s+([^(]+)"))])


def clock_seconds(clock: Column) -> Column:
    """Seconds of a clock mm:ss; 0 without a colon. Digits that are none raise an error under ANSI rules."""
    parts = F.split(clock, ":")
    return F.when(clock.contains(":"), F.get(parts, F.lit(0)).cast("int") * 60 + F.get(parts, F.lit(1)).cast("int")).otherwise(F.lit(0))


def without_dots(text: Column) -> Column:
    """Text without surrounding spaces and closing dots."""
    bare = F.trim(text)
    return F.when(bare.contains("."), F.regexp_replace(bare, r"\.+$", "")).otherwise(bare)


def label(text: Column) -> Column:
    """Team label in a form to compare: trimmed, no closing dots, single spaces, upper case."""
    return F.upper(F.regexp_replace(F.trim(without_dots(text)), r"\s+", " "))


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


#: How names with commas are put in order, of three parts and of two; the first pattern that fits leaves no comma for the others.
_ENDING = f"((?i:{'|'.join(x.replace('.', '[.]') for x in sorted(NAME_ENDINGS, key=len, reverse=True))}))"
_REORDERED = (
    (rf"^([^,]*?)\s*,\s*{_ENDING}\s*,\s*([^,]*?)\s*(?:,.*)?$", "$3 $1 $2"),
    (rf"^([^,]*?)\s*,\s*([^,]*?)\s*,\s*{_ENDING}\s*(?:,.*)?$", "$2 $1 $3"),
    (r"^([^,]*?)\s*,\s*([^,]*?)\s*,\s*([^,]*?)\s*(?:,.*)?$", "$2 $3 $1"),
    (rf"^([^,]*?)\s*,\s*{_ENDING}$", "$1 $2"),
    (r"^([^,]*?)\s*,\s*([^,]*)$", "$2 $1"),
)


def spaced(raw: Column) -> Column:
    """A name as written, trimmed and with single spaces."""
    return F.regexp_replace(F.trim(raw), r"\s+", " ")


def in_order(name: Column) -> Column:
    """`First Last [ending]` from the forms of a spaced name; null without a name. Only the patterns for its number of commas run."""
    ordered = lambda rules: reduce(lambda x, rule: F.regexp_replace(x, *rule), rules, name)
    return chain(
        [
            (name.isNull() | (name == ""), F.lit(None).cast("string")),
            (F.upper(name).isin(*NO_PERSON), F.upper(name)),
            (F.substring_index(name, ",", 2) != name, ordered(_REORDERED[:3])),
            (name.contains(","), ordered(_REORDERED[3:])),
        ],
        name,
    )


def person_name(raw: Column) -> Column:
    """`First Last [ending]` from `Last, First` and its forms with an ending such as Jr; null without a name."""
    return in_order(spaced(raw))


def person_names(raw: Column) -> Column:
    """The same of an array of names with closing dots; each pattern stands in the plan once, and is evaluated once for a name."""
    return F.transform(F.transform(raw, lambda x: spaced(without_dots(x))), in_order)


def is_person(name: Column) -> Column:
    return ~F.upper(name).isin(*NO_PERSON)


def shot_result(text: Column) -> Column:
    """GOAL, SAVE or the ending of a shot text; null for other plays and unknown endings."""
    ending = part(text, rf" ({'|'.join(SHOT_ENDINGS)})\.*\z")
    saved = text.contains(", SAVE ") | text.contains(", SAVE,") | text.contains("SAVE by")
    shot = F.when(saved, F.lit("SAVE")).otherwise(F.try_element_at(F.create_map(*[F.lit(x) for pair in SHOT_ENDINGS.items() for x in pair]), ending))
    return F.when(text.startswith("GOAL by"), F.lit("GOAL")).when(text.startswith("Shot by"), shot)


def part(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of a pattern, empty where it doesn't match."""
    return F.regexp_extract(text, pattern, group)


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """The same, null where it doesn't match or is empty. Within a condition's branches the pattern runs twice, so prefer part there."""
    return F.nullif(part(text, pattern, group), F.lit(""))


def found_by(text: Column, pattern: Column, group: int = 1) -> Column:
    """The same with a pattern that differs by row."""
    return F.nullif(F.call_function("regexp_extract", text, pattern, F.lit(group)), F.lit(""))
