"""Rules looked up by threshold against the same rules tried one by one."""

import random
import time

from pyspark.sql import functions as F

from adlens.operators import rule_index, rules

REPORT = "campaign_id string, ad_group_id string, acos double, roas double, conversion double, ctr double"


def random_rules(n, seed):
    rnd = random.Random(seed)
    number = lambda: rnd.choice([f"{rnd.randint(-5, 60) / 4}", str(rnd.randint(0, 12)), "-2.5", "1e1", "- -3"])
    def comparison():
        metric, op = rnd.choice(rules.METRICS), rnd.choice(["<", "<=", ">", ">=", "=="])
        return rnd.choice([f"{metric} {op} {number()}", f"{number()} {op} {metric}", f"{number()} < {metric} <= {number()}"])
    out = [" and ".join(comparison() for _ in range(rnd.randint(1, 3))) for _ in range(n)]
    out[::40] = [rnd.choice(["not roas < 2", "acos != 4", "roas < 1 or ctr >= 3", "acos > 2 * 2.5", "(ctr) < 2", "acos / roas > 1"]) for _ in out[::40]]
    return [{"condition": c, "action": "a", "percentage": k, "description": None if k % 3 else f"d{k}"} for k, c in enumerate(out)]


def report(spark, n, seed):
    rnd = random.Random(seed)
    value = lambda: rnd.choice([None, 0.0, -0.0, float(rnd.randint(0, 12)), rnd.randint(-20, 80) / 4, rnd.random() * 15])
    rows = [(f"c{k // 3}", f"g{k // 2}", value(), value(), value(), value()) for k in range(n)]  # some equal keys
    return spark.createDataFrame([*rows, rows[0]], REPORT), [*rows, rows[0]]


def plain(rows, given):
    want = []
    for c, g, *values in rows:
        names = {m: v or 0.0 for m, v in zip(rules.METRICS, values)}
        for rule in given:
            try:
                if eval(rule["condition"], {}, names):
                    want.append((c, g, rule["percentage"], "Rule triggered: " + rule["condition"]))
            except ZeroDivisionError:
                pass
    return sorted(want)


def test_ten_thousand_rules_equal_the_plain_pass(spark):
    given = random_rules(10_000, 7)
    frame, rows = report(spark, 60, 8)
    started = time.time()
    got = sorted((r.campaign_id, r.ad_group_id, r.percentage, r.reason) for r in rules.bid_adjustments(frame, given).collect())
    assert time.time() - started < 60
    assert got == plain(rows, given)


def test_indexed_recommendations_equal_the_array_of_rules(spark, monkeypatch):
    given = random_rules(260, 3)
    frame, _ = report(spark, 25, 4)
    looked_up = sorted(map(str, rules.bid_recommendations(frame, given).collect()))
    assert rules.bid_recommendations(frame, given).schema.simpleString() == rules.bid_recommendations(frame).schema.simpleString()
    monkeypatch.setattr(rule_index, "BROADCAST_NODES", 0)
    assert sorted(map(str, rules.bid_recommendations(frame, given).collect())) == looked_up
    monkeypatch.setattr(rules, "RULES_PER_ARRAY", 1000)
    assert sorted(map(str, rules.bid_recommendations(frame, given).collect())) == looked_up


def test_simple_conditions():
    assert rules.simple_comparisons("roas < 1.0") == [("roas", "<", 1.0)]
    assert rules.simple_comparisons("-1 <= acos < 2 and ctr == +3") == [("acos", ">=", -1.0), ("acos", "<", 2.0), ("ctr", "==", 3.0)]
    for other in ["roas", "roas < acos", "1 < 2", "-roas < 1", "roas != 1", "roas < 1 or acos < 1", "not roas < 1", "(roas) < 1",
                  "roas < 2 * 3", "roas < 1 and", "and roas < 1", "roas <", "roas < < 1"]:
        assert rules.simple_comparisons(other) is None, other


def test_faulty_rules_among_many(spark):
    given = [{"condition": f"roas < {k}", "action": "a", "percentage": 1} for k in range(300)]
    given += [{"condition": "roas <", "action": "b", "percentage": 1}, {"condition": "spend > 1", "action": "c", "percentage": 1},
              {"condition": "roas < 1 and roas > 2", "action": "never", "percentage": 1}]
    assert sorted(r.action for r in rules.rejected_rules(spark, given).collect()) == ["b", "c"]
    frame = spark.createDataFrame([("c", "g", 0.0, 298.0, 0.0, 0.0)], REPORT)
    assert [r.reason for r in rules.bid_adjustments(frame, given).collect()] == ["Rule triggered: roas < 299"]
    assert rules.bid_adjustments(frame.filter("false"), given).count() == 0


def test_tree_nodes_hold_each_place_once():
    for first in range(16):
        for end in range(first, 17):
            under = [p for n in rule_index.tree_nodes(first, end, 4)
                     for p in range((n << (5 - n.bit_length())) - 16, ((n + 1) << (5 - n.bit_length())) - 16)]
            assert sorted(under) == list(range(first, end)), (first, end)


def test_no_row_meets_a_rule_outside_its_range(spark):
    """With one comparison per rule, the join on nodes brings just the rules that fire, each once."""
    given = [{"condition": f"{m} {op} {k}", "action": "a", "percentage": 1} for m in rules.METRICS for op in ("<", ">=") for k in range(50)]
    frame, _ = report(spark, 30, 5)
    compiled, _ = rules.compile_rules(given, frame)
    fired = rules._fired(frame, compiled)
    plan = fired._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan and "BroadcastNestedLoop" not in fired._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan                                    # thresholds are a folded constant
    index = rule_index.RuleIndex([(r.index, r.comparisons) for r in compiled], rules.METRICS)
    assert len({n for n in index.nodes}) == len(index.nodes)
    assert len(index.shifts) <= sum(d + 1 for d in index.depth.values())
    keys = rules._metric_frame(frame).select("*", *[rule_index.place_of(F.col(f"_m_{m}"), index.thresholds[m]).alias(f"_p_{m}") for m in rules.METRICS])
    met = keys.select(F.explode(F.array(*index.keys({m: F.col(f"_p_{m}") for m in rules.METRICS}))).alias("_node"))
    nodes = spark.createDataFrame(index.nodes, "_node bigint, rule int")
    assert met.join(nodes, "_node").count() == fired.count() == len(plain(report(spark, 30, 5)[1], given))
