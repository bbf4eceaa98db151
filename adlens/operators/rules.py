"""Bidding rules compiled to Column expressions.

A rule condition is a small boolean text over four metric names.  Instead
of text substitution and ``eval`` per row, each condition is checked
against a whitelist, rewritten to Spark SQL and compiled once with
``F.expr``; all rules are then evaluated in one narrow pass as an array of
``when(condition, struct)`` that is filtered and exploded.  Of more than
``RULES_PER_ARRAY`` rules, those of simple comparisons are looked up by their
thresholds instead (``rule_index``).  Rules are configuration, not data.
"""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.functions.metrics import zero_if_null
from adlens.operators import rule_index

log = logging.getLogger(__name__)

# The default rules (conditions, actions, percentages, descriptions).
DEFAULT_RULES = [
    {"condition": "roas < 1.0", "action": "decrease_bid", "percentage": 20,
     "description": "ROAS below 1 is losing money, decrease bids by 20%"},
    {"condition": "roas >= 4.0", "action": "increase_bid", "percentage": 10,
     "description": "ROAS above 4 is performing well, increase bids by 10% to gain more volume"},
    {"condition": "acos > 40.0", "action": "decrease_bid", "percentage": 15,
     "description": "ACOS above 40% is concerning, decrease bids by 15%"},
    {"condition": "conversion > 10.0 and roas >= 3.0", "action": "increase_bid", "percentage": 15,
     "description": "High conversion rate with good ROAS, increase bids by 15% to gain more volume"},
]

# The metric names a condition may use, and the report column each one reads.
METRICS = ("acos", "roas", "conversion", "ctr")
# Rules to one expression array.  Of more rules, the simple ones are looked up by threshold; the
# others make more arrays, in the same pass.
RULES_PER_ARRAY = 200

_TOKEN = re.compile(r"""\s*(?:
    (?P<num>(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?)
  | (?P<name>[A-Za-z_]\w*)
  | (?P<op><=|>=|==|!=|<|>)
  | (?P<sign>[-+*/])
  | (?P<paren>[()])
  )""", re.VERBOSE)
_WORDS = {"and": "AND", "or": "OR", "not": "NOT"}
_OPS = {"==": "=", "!=": "<>"}


class InvalidRule(ValueError):
    pass


@dataclass(frozen=True)
class CompiledRule:
    index: int
    condition: str
    action: str
    percentage: float
    description: str | None
    predicate: Column | None                                        # None: looked up by ``comparisons``
    comparisons: tuple[tuple[str, str, float], ...] | None = None

    @property
    def payload(self) -> tuple:
        return self.action, self.percentage, self.description, f"Rule triggered: {self.condition}"


PAYLOAD = "struct<action:string,percentage:double,description:string,reason:string>"


def _tokens(condition: str) -> list[tuple[str, str]]:
    """(kind, text) of a whitelisted condition, in order."""
    out, pos = [], 0
    text = condition.rstrip()
    while pos < len(text):
        m = _TOKEN.match(text, pos)
        if not m or m.end() == pos:
            raise InvalidRule(f"unexpected text at {pos}: {text[pos:pos + 10]!r}")
        pos = m.end()
        kind = m.lastgroup
        word = m.group(kind)
        if kind == "name":
            if word not in METRICS and word not in _WORDS:
                raise InvalidRule(f"unknown name {word!r}")
            kind = "word" if word in _WORDS else kind
        out.append((kind, word))
    if not out:
        raise InvalidRule("empty condition")
    return out


def _safe_division(term: str) -> str:
    """Divisors that are 0 become null, so such a rule doesn't fire and the job doesn't fail."""
    out, k = [], 0
    words = term.split(" ")
    while k < len(words):
        out.append(words[k])
        k += 1
        if out[-1] != "/":
            continue
        # The divisor: signs, then a number, a name or a parenthesis.
        start, depth = k, 0
        while k < len(words) and words[k] in "+-":
            k += 1
        while k < len(words):
            depth += {"(": 1, ")": -1}.get(words[k], 0)
            k += 3 if words[k].startswith("CAST(") else 1
            if depth == 0:
                break
        out.append(f"nullif({_safe_division(' '.join(words[start:k]))}, CAST('0' AS DOUBLE))")
    return " ".join(out)


def to_sql(condition: str) -> str:
    """Rewrite a whitelisted condition to Spark SQL over ``_m_<metric>`` columns.

    Between ``and``, ``or``, ``not`` and the parentheses around them stand
    comparisons of arithmetic terms; ``a < b < c`` means ``a < b AND b < c``.
    """
    tokens = _tokens(condition)
    closing, open_at = {}, []
    for k, (_, t) in enumerate(tokens):
        if t == "(":
            open_at.append(k)
        elif t == ")":
            if not open_at:
                raise InvalidRule("unbalanced parentheses")
            closing[open_at.pop()] = k
    if open_at:
        raise InvalidRule("unbalanced parentheses")

    def logical(a: int, b: int) -> bool:
        return any(kind in ("word", "op") for kind, _ in tokens[a:b])

    def term(a: int, b: int) -> str:
        if a == b:
            raise InvalidRule("a side of a comparison is missing")
        parts = []
        for kind, t in tokens[a:b]:
            parts.append(f"CAST('{t}' AS DOUBLE)" if kind == "num" else f"_m_{t}" if kind == "name" else t)
        return _safe_division(" ".join(parts))

    def comparison(a: int, b: int) -> str:
        cuts, k = [], a
        while k < b:
            if tokens[k][0] == "op":
                cuts.append(k)
            k = closing[k] + 1 if k in closing else k + 1
        if not cuts:
            return f"({term(a, b)})"
        edges = [a, *[c + 1 for c in cuts]]
        sides = [term(x, y) for x, y in zip(edges, [*cuts, b])]
        tests = [f"(({x}) {_OPS.get(tokens[c][1], tokens[c][1])} ({y}))" for x, c, y in zip(sides, cuts, sides[1:])]
        return "(" + " AND ".join(tests) + ")"

    def boolean(a: int, b: int) -> str:
        out, k = [], a
        while k < b:
            kind, t = tokens[k]
            if kind == "word":
                out.append(_WORDS[t])
                k += 1
            elif k in closing and logical(k + 1, closing[k]):
                out.append(f"({boolean(k + 1, closing[k])})")
                k = closing[k] + 1
                if k < b and tokens[k][0] != "word":
                    raise InvalidRule("a comparison can't be compared")
            else:
                end = k
                while end < b and tokens[end][0] != "word":
                    if end in closing and logical(end + 1, closing[end]):
                        raise InvalidRule("a comparison can't be compared")
                    end = closing[end] + 1 if end in closing else end + 1
                out.append(comparison(k, end))
                k = end
        return " ".join(out)

    return boolean(0, len(tokens))


def _operand(tokens: list[tuple[str, str]]) -> str | float | None:
    """A metric's name or a signed number; None for anything else."""
    sign, k = 1.0, 0
    while k < len(tokens) - 1 and tokens[k] in (("sign", "+"), ("sign", "-")):
        sign = -sign if tokens[k][1] == "-" else sign
        k += 1
    if len(tokens) != k + 1 or tokens[k][0] not in ("num", "name"):
        return None
    kind, t = tokens[k]
    return sign * float(t) if kind == "num" else t if k == 0 else None


def simple_comparisons(condition: str) -> list[tuple[str, str, float]] | None:
    """(metric, operator, number) of each comparison, if the condition is such comparisons joined by ``and``; else None."""
    out: list[tuple[str, str, float]] = []
    sides, ops = [[]], []
    for kind, t in [*_tokens(condition), ("word", "and")]:
        if kind == "op":
            ops.append(t)
            sides.append([])
        elif kind != "word":
            sides[-1].append((kind, t))
        elif t != "and" or not ops:
            return None
        else:
            values = [_operand(s) for s in sides]
            for a, op, b in zip(values, ops, values[1:]):
                if a is None or b is None or op not in rule_index.FLIPPED or isinstance(a, str) == isinstance(b, str):
                    return None
                out.append((a, op, b) if isinstance(a, str) else (b, rule_index.FLIPPED[op], a))
            sides, ops = [[]], []
    return out


def _metric_frame(df: DataFrame) -> DataFrame:
    """The metrics as rules see them: missing values are 0."""
    return df.withColumns({f"_m_{m}": zero_if_null(m) for m in METRICS})


def compile_rules(rules: list[dict], probe: DataFrame) -> tuple[list[CompiledRule], list[tuple[dict, str]]]:
    """Compile every rule; invalid ones are returned with the reason and skipped.

    ``probe`` is any frame carrying the four metric columns; the compiled
    predicates are resolved against it (analysis only, no job runs).  Of more
    than ``RULES_PER_ARRAY`` rules, simple ones get comparisons and no predicate.
    """
    frame = _metric_frame(probe)
    ok, rejected = [], []
    for i, rule in enumerate(rules):
        try:
            cond = rule["condition"]
            simple = simple_comparisons(cond) if len(rules) > RULES_PER_ARRAY else None
            if simple is not None:
                ok.append(CompiledRule(i, cond, str(rule["action"]), float(rule["percentage"]),
                                       rule.get("description"), None, tuple(simple)))
                continue
            pred = F.expr(to_sql(cond))
            dtype = frame.select(pred.alias("p")).schema["p"].dataType
            if not isinstance(dtype, T.BooleanType):
                raise InvalidRule(f"condition is {dtype.simpleString()}, not boolean")
            ok.append(CompiledRule(i, cond, str(rule["action"]), float(rule["percentage"]),
                                   rule.get("description"), pred))
        except Exception as e:  # noqa: BLE001 - any faulty rule is reported and skipped
            log.error("Error evaluating rule condition %r: %s", rule.get("condition"), e)
            rejected.append((rule, str(e).splitlines()[0] if str(e) else type(e).__name__))
    return ok, rejected


def _fired(df: DataFrame, compiled: list[CompiledRule]) -> DataFrame:
    """Rows x matching rules as ``r``; 0..n output rows per input row, in rule order unless rules are looked up."""
    frame = _metric_frame(df)
    if any(r.predicate is None for r in compiled):
        index = rule_index.RuleIndex([(r.index, r.comparisons) for r in compiled if r.predicate is None], METRICS)
        tested = [(r.index, r.predicate) for r in compiled if r.predicate is not None]
        return rule_index.fired_by_index(frame, index, tested, [(r.index, *r.payload) for r in compiled], PAYLOAD)
    names = ("action", "percentage", "description", "reason")
    candidates = [F.when(r.predicate, F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r.payload)]).cast(PAYLOAD)) for r in compiled]
    parts = [F.filter(F.array(*candidates[a:a + RULES_PER_ARRAY]), lambda x: x.isNotNull())
             for a in range(0, len(candidates), RULES_PER_ARRAY)]
    return frame.select("*", F.explode(F.concat(*parts)).alias("r"))


def _no_rows(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The output shape with no rows, when no rule is usable."""
    return df.filter(F.lit(False)).select(*[F.lit(None).cast(t).alias(c) for c, t in columns.items()])


def rejected_rules(spark: SparkSession, rules: list[dict]) -> DataFrame:
    """The rules that can't be used, with the reason: one row each."""
    probe = spark.createDataFrame([], ", ".join(f"{m} double" for m in METRICS))
    _, rejected = compile_rules(rules, _metric_frame(probe))
    rows = [(str(r.get("condition")), str(r.get("action")), why) for r, why in rejected]
    return spark.createDataFrame(rows, "condition string, action string, reason string")


def bid_adjustments(report: DataFrame, rules: list[dict] | None = None) -> DataFrame:
    """Every matching rule of every ad group emits one adjustment."""
    compiled, _ = compile_rules(DEFAULT_RULES if rules is None else rules, _metric_frame(report))

    if not compiled:
        return _no_rows(report, {"campaign_id": "string", "ad_group_id": "string", "action": "string",
                                 "percentage": "double", "reason": "string"})
    out = _fired(report, compiled)
    return out.select("campaign_id", "ad_group_id", "r.action", "r.percentage", "r.reason")


def bid_recommendations(campaigns: DataFrame, rules: list[dict] | None = None) -> DataFrame:
    """Per-campaign recommendations with the metrics the rules saw."""
    compiled, _ = compile_rules(DEFAULT_RULES if rules is None else rules, _metric_frame(campaigns))

    if not compiled:
        return _no_rows(campaigns, {
            "campaign_id": "string",
            "current_metrics": "struct<acos:double,roas:double,conversion:double,ctr:double>",
            "action": "string", "percentage": "double", "description": "string", "reason": "string"})
    out = _fired(campaigns, compiled)
    metrics = F.struct(*[F.col(f"_m_{m}").alias(m) for m in METRICS])
    return out.select("campaign_id", metrics.alias("current_metrics"),
                      "r.action", "r.percentage", "r.description", "r.reason")
