"""Licence scans with DataFrame functions only.

A keyword test lets through the texts that can hold a signature. Those are cut
into words; every keyword is an anchor, and only the rules that start with it look
at the words from there on. An opening of a grant is matched once; the word after it
decides which names are looked for. Detections are word intervals. One that lies within
another of the same or a better tier is suppressed: in order of (start, longest
first, tier, rule), that is when an earlier one of such a tier reaches as far, so
one running maximum per tier decides it. All of it happens inside a row: nothing
is shuffled, and equal rows do not meet.

Defined results: null text counts as empty; texts without words or signatures have
no labels, null positions and score 0; repeated rows are scanned each on their own; very long
texts are scanned whole; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.license_rules import BASE, REACH, RULES, Rule

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # either case
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of lower-case text
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TIERS = (1, 2, 3)
WEIGHT = {1: 1.0, 2: 0.9, 3: 0.6}
BASE_WEIGHT = 0.5

#: Every rule and base phrase holds one of these, so a text without them has no detection.
_SEP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"  # between words of either case, '_' included
PREFILTER = (
    rf"(?i)licen[cs]|gpl|apache|(?:^|{_SEP})cc0|(?:^|{_SEP})cc{_SEP}+by|creative{_SEP}+commons|public{_SEP}+domain|permission"
    rf"|redistribut|advertising|copyright|warranty|wtfpl|mpl{_SEP}+2|bsd|asl{_SEP}+2|mit{_SEP}+no|neither{_SEP}+the"
)


#: Pieces of the test's alternatives, in lower case: a text with one of the first passes at once, one with
#: none of either fails at once, and only the others are searched with the expression.
PLAIN = ("licenc", "licens", "gpl", "apache", "permission", "redistribut", "advertising", "copyright", "warranty", "wtfpl", "bsd")
DOUBTFUL = ("cc0", "cc", "commons", "domain", "mpl", "asl", "mit", "neither")

Numbered = list[tuple[int, Rule]]


def _by(key: Callable[[Rule], str], rules: Numbered) -> dict[str, Numbered]:
    groups: dict[str, Numbered] = {}
    for number, rule in rules:
        groups.setdefault(key(rule), []).append((number, rule))
    return groups


def _words_sql(text: str) -> str:
    return f"length({text}) - length(replace({text}, ' ', '')) + 1"


def _matches_sql(rules: Numbered, after: str, before: str = "0") -> str:
    """What the names of some rules find in the words `after`, which `before` words follow the anchor `a`; as SQL, for
    the list is long.
    """
    found = ", ".join(
        f"named_struct('match', regexp_extract({after}, r'^(?:{rule.name})(?= |$)', 0), "
        f"'tier', {rule.tier}, 'rule', {number}, 'label', '{rule.label}')"
        for number, rule in rules
    )
    return (
        f"transform(filter(array({found}), d -> d.match != ''), d -> named_struct("
        f"'start', a.at, 'minus_end', -(a.at + {before} + {_words_sql('d.match')}), 'tier', d.tier, 'rule', d.rule, 'label', d.label))"
    )


def _granted_sql(grant: str, rules: Numbered) -> str:
    """What stands after the opening of a grant, which is looked for once."""
    cases = " ".join(
        f"when '{word}' then {_matches_sql(named, 'n.after', 'n.words')}" for word, named in _by(lambda r: r.name_keyword, rules).items()
    )
    opening = f"filter(array(regexp_extract(a.after, r'^(?:{grant})(?= )', 0)), g -> g != '')"
    names = (
        f"transform({opening}, g -> named_struct('words', {_words_sql('g')}, 'after', substring(a.after, length(g) + 2)))"
    )
    return f"flatten(filter(transform({names}, n -> case substring_index(n.after, ' ', 1) {cases} end), x -> x is not null))"


def _anchored_sql(rules: Numbered) -> str:
    """What the rules of one keyword find at an anchor `a`."""
    parts = [
        _granted_sql(grant, some) if grant else _matches_sql(some, "a.after") for grant, some in _by(lambda r: r.grant, rules).items()
    ]
    return f"concat({', '.join(parts)})" if len(parts) > 1 else parts[0]


def _detections(words: str) -> Column:
    """All detections of one text, sorted by (start, longest first, tier, rule)."""
    groups = _by(lambda r: r.keyword, list(enumerate(RULES)))
    keywords = ", ".join(f"'{k}'" for k in groups)
    anchors = (
        f"filter(transform({words}, (w, i) -> if(w in ({keywords}), named_struct('at', cast(i as bigint), 'word', w, "
        f"'after', array_join(slice({words}, i + 1, {REACH}), ' ')), null)), a -> a is not null)"
    )
    cases = " ".join(f"when '{word}' then {_anchored_sql(rules)}" for word, rules in groups.items())
    return F.expr(f"array_sort(flatten(transform({anchors}, a -> case a.word {cases} end)))")


def _unsuppressed(detections: Column) -> Column:
    """Detections that no other of the same or a better tier contains."""
    start = F.struct(
        *[F.lit(-1).cast("long").alias(f"t{t}") for t in TIERS],
        F.filter(detections, lambda d: F.lit(False)).alias("kept"),
    )

    def step(acc: Column, d: Column) -> Column:
        end = -d["minus_end"]
        inside = F.greatest(*[F.when(F.lit(t) <= d["tier"], acc[f"t{t}"]).otherwise(F.lit(-1).cast("long")) for t in TIERS]) >= end
        return F.struct(
            *[F.when(d["tier"] == t, F.greatest(acc[f"t{t}"], end)).otherwise(acc[f"t{t}"]).alias(f"t{t}") for t in TIERS],
            F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(d))).alias("kept"),
        )

    return F.aggregate(detections, start, step, lambda acc: acc["kept"])


def _base(words: Column) -> Column:
    """Starts and labels of the base phrases."""
    def at(i: Column, phrase: list[str]) -> Column:
        tests = [F.get(words, i + j) == word for j, word in enumerate(phrase)]
        test = tests[0]
        for other in tests[1:]:
            test = test & other
        return test

    firsts = sorted({phrase.split()[0] for phrase in BASE})
    starts = F.filter(
        F.transform(words, lambda w, i: F.when(w.isin(*firsts), i)), lambda i: i.isNotNull()
    )
    found = F.transform(starts, lambda i: F.struct(i.cast("long").alias("at"), F.coalesce(
        *[F.when(at(i, phrase.split()), F.lit(label)) for phrase, label in BASE.items()]
    ).alias("label")))
    return F.filter(found, lambda b: b["label"].isNotNull())


def _may_hold(whole: Column) -> Column:
    """Whether a text passes the keyword test `PREFILTER`."""
    low = F.lower(whole)  # letters that only become ASCII here can add doubtful texts, not lose any

    def holds(pieces: tuple[str, ...]) -> Column:
        return reduce(or_, [F.contains(low, F.lit(piece)) for piece in pieces])

    return holds(PLAIN) | (holds(DOUBTFUL) & whole.rlike(PREFILTER))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """`doc` (all input columns), word count, base places, detections and score of every row."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.regexp_count(whole, F.lit(WORD)).cast("long").alias("n_words"),
        F.when(_may_hold(whole), F.filter(
            F.split(F.regexp_replace(F.translate(whole, UPPER, SMALL), GAP, " "), " "), lambda w: w != ""
        )).otherwise(F.array().cast("array<string>")).alias("words"),
    )
    rows = rows.select("doc", "n_words", "words", F.when(F.size("words") > 0, _detections("words")).alias("found"))
    found = rows.select(
        "doc", "n_words",
        F.when(F.size("words") > 0, _base(F.col("words"))).alias("base"),
        F.when(F.size("found") > 0, _unsuppressed(F.col("found"))).otherwise(F.filter("found", lambda d: F.lit(False))).alias("kept"),
    )
    starts = F.transform("base", lambda b: b["at"])
    base_labels = F.transform("base", lambda b: b["label"])
    score = F.aggregate(
        "kept", F.when(F.size("base") > 0, F.lit(BASE_WEIGHT)).otherwise(F.lit(0.0)),
        lambda best, d: F.greatest(best, F.element_at(
            F.create_map(*[x for t in TIERS for x in (F.lit(t), F.lit(WEIGHT[t]))]), d["tier"])),
    )
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc", "n_words",
        F.coalesce(F.when(F.size("base") >= 0, F.size("base")), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.coalesce(listed(base_labels), F.lit("")).alias("base_labels"),
        F.coalesce(listed(F.concat(base_labels, F.transform("kept", lambda d: d["label"]))), F.lit("")).alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
        F.transform("kept", lambda d: F.struct(
            d["label"].alias("label"), d["tier"].alias("tier"), d["start"].alias("start"), (-d["minus_end"]).alias("end")
        )).alias("detections"),
    )


def python_rules() -> list[tuple[Rule, re.Pattern]]:
    """The rules as Python patterns, for a reader or a test that works without Spark."""
    return [(rule, re.compile(rf"(?:{rule.pattern})(?= |$)")) for rule in RULES]
