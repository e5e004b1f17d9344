"""Secret scan through a trigram index.

Each rule's regex gives a Boolean query of the trigrams every match must contain, derived from its
parse tree. Postings (trigram, text) are kept for the trigrams that some query names. A query is an
OR of ANDs; a text is a candidate of a rule if it holds all trigrams of one AND, found by uniting its
postings per AND. Candidates are then verified with the regexes; rules without mandatory trigrams
scan every text.

Only DataFrame functions are used. Texts are known by two 64-bit hashes, so copies share postings.
Places come from the pieces between matches, in code points. Case is folded in the index only.

Defined cases: a null text counts as empty and gives zeros and empty strings; an empty table gives no
rows; repeated rows give repeated results; whole texts are scanned whatever their length.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parceltide.llm import common


class Rule(NamedTuple):
    kind: str
    pattern: str  # understood alike by Java and Python
    group: int = 0  # the part that has to be ...
    least: int = 0  # ... at least so long


# The base kinds first, in their order.
RULES = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("github", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("github_fine", r"github_pat_[A-Za-z0-9_]{22,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"(?:xoxb|xoxa|xoxp|xoxr|xoxs)-[A-Za-z0-9-]{10,}"),
    Rule("slack_hook", r"hooks\.slack\.com/services/[A-Za-z0-9/_-]{20,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"(?:sk|rk)_live_[A-Za-z0-9]{20,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36}"),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_-]{20,}\.[A-Za-z0-9_-]{30,}"),
    Rule("bearer", r"(?i)authorization: bearer [A-Za-z0-9._~+/-]{16,}"),
    Rule("url_login", r"://[A-Za-z0-9._-]{1,64}:[^\x00-\x20/@:]{4,64}@"),
]
BASE_KINDS = ("assign", "access", "hex")

# --- trigram queries -------------------------------------------------------------------------

MOST_STRINGS = 16
Query = list[frozenset[str]]  # OR of ANDs; an AND of nothing is met by every text


def trigram_query(pattern: str) -> Query:
    """Trigrams (lower case) that every match contains. Runs of the pattern that stand for few
    strings are spelled out; each run adds an AND of the ORs of its strings' trigrams."""
    runs = [[""]]
    for strings in _spell(sre_parser.parse(pattern)):
        if strings is None:
            runs.append([""])
            continue
        longer = [a + b for a in runs[-1] for b in strings]
        runs[-1:] = [longer] if len(longer) <= MOST_STRINGS else [runs[-1], list(strings)]
    ands: Query = [frozenset()]
    for strings in runs:
        if all(len(s) >= 3 for s in strings):
            options = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
            product = [a | b for a in ands for b in sorted(options, key=sorted)]
            ands = product if len(product) <= MOST_STRINGS else ands
    return ands


def _spell(tree) -> list[set[str] | None]:
    """The pattern as pieces in order: the strings a piece can be, or None where it can be anything."""
    out: list[set[str] | None] = []
    for op, value in tree:
        if op is sre.LITERAL:
            out.append({chr(value).lower()})
        elif op is sre.SUBPATTERN:
            out += _spell(value[3])
        elif op is sre.BRANCH:
            branches = [_whole(branch) for branch in value[1]]
            out.append(None if None in branches else set().union(*branches))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[:2] == (0, 1):
            inner = _whole(value[2])
            out.append(None if inner is None else inner | {""})
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] == value[1] <= 4:
            out += _spell(value[2]) * value[0]
        elif op is sre.IN and all(x[0] is sre.LITERAL for x in value) and len(value) <= 8:
            out.append({chr(x[1]).lower() for x in value})
        elif op is not sre.AT:
            out.append(None)
    return out


def _whole(tree) -> set[str] | None:
    strings = {""}
    for piece in _spell(tree):
        if piece is None or len(strings) * len(piece) > MOST_STRINGS:
            return None
        strings = {a + b for a in strings for b in piece}
    return strings


def queries_of(rules: list[Rule]) -> dict[int, Query]:
    """Rule number to query, for the rules that have mandatory trigrams."""
    found = {i: trigram_query(rule.pattern) for i, rule in enumerate(rules)}
    return {i: q for i, q in found.items() if all(q)}


# --- candidates ------------------------------------------------------------------------------


def _text_key() -> list[Column]:
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")]


def candidates(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """(t1, t2, rules): texts that may match, with the rules as bits. Needs ``text``."""
    queries = queries_of(rules)
    ands = [(rule, terms) for rule, query in queries.items() for terms in query]
    vocabulary = sorted({t for _, terms in ands for t in terms})
    low = docs.select(*_text_key(), F.lower("text").alias("low"))
    flags = [F.when(F.contains("low", F.lit(t)), t) for t in vocabulary]
    postings = low.select("t1", "t2", F.explode(F.array_compact(F.array(*flags))).alias("trigram"))
    # Which AND a trigram belongs to, and its place there. The rules bound this table.
    terms = docs.sparkSession.createDataFrame(
        [(t, n, 1 << i, (1 << len(terms)) - 1, 1 << rule) for n, (rule, terms) in enumerate(ands)
         for i, t in enumerate(sorted(terms))],
        "trigram string, term_set int, bit bigint, whole bigint, rule bigint")
    met = postings.join(F.broadcast(terms), "trigram").groupBy("t1", "t2", "term_set").agg(
        F.bit_or("bit").alias("bits"), F.first("whole").alias("whole"), F.first("rule").alias("rule"))
    return met.filter("bits = whole").groupBy("t1", "t2").agg(F.bit_or("rule").alias("rules"))


# --- verification ----------------------------------------------------------------------------


def spans(text: Column, rule: Rule) -> Column:
    """Matches as array<struct<start, end>> in code points, leftmost and non-overlapping."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, rule.pattern, -1)
    part = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    lengths = F.arrays_zip(
        F.transform(between, lambda s: F.char_length(s).cast("bigint")).alias("gap"),
        F.transform(found, lambda s: F.char_length(s).cast("bigint")).alias("len"),
        F.transform(part, lambda s: F.char_length(s).cast("bigint")).alias("part"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    placed = F.aggregate(
        F.filter(lengths, lambda x: x["len"].isNotNull()),
        F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("found")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["len"]).alias("at"),
            F.when(x["part"] >= rule.least, F.concat(acc["found"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["len"]).alias("end")))))
            .otherwise(acc["found"]).alias("found")),
        lambda acc: acc["found"])
    return placed


def find_secrets(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, found: array of (start, kind number, end) per row of ``docs``."""
    rules = RULES if rules is None else rules
    rows = docs.select("doc_id", common.text_or_empty().alias("text"))
    indexed = queries_of(rules)
    marked = rows.select("*", *_text_key()).join(candidates(rows, rules), ["t1", "t2"], "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")

    def of_rule(i: int) -> Column:
        rule = rules[i]
        wanted = (F.col("rules").bitwiseAND(F.lit(1 << i)) != 0) if i in indexed else F.lit(True)
        return F.when(wanted & F.rlike("text", F.lit(rule.pattern)), F.transform(
            spans(F.col("text"), rule), lambda s: F.struct(
                s["start"].alias("start"), F.lit(i).alias("kind"), s["end"].alias("end")))
        ).otherwise(none)

    return marked.select("doc_id", F.array_sort(F.concat(*map(of_rule, range(len(rules))))).alias("found"))


def _joined(found: Column, rules: list[Rule]) -> Column:
    names = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(common.table(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("found", lambda s: s["kind"] < len(BASE_KINDS))
    return found.select(
        "doc_id", *(count(i).alias(f"n_{kind}") for i, kind in enumerate(BASE_KINDS)),
        F.sha2(_joined(base, RULES), 256).alias("base_sha256"), _joined(F.col("found"), RULES).alias("spans"))
