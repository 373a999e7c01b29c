from itertools import combinations

import pytest
from pyspark.sql import functions as F

from clientele.operators import basket as B

ORDERS = {"o1": ["a", "b", "c", "a"], "o2": ["a", "b"], "o3": ["b", "c"], "o4": ["a", "c", "d"],
          "o5": ["a", "b", "c", "d"], "o6": ["d"]}


def brute_force(min_support, min_conf):
    baskets = [set(v) for v in ORDERS.values()]
    n = len(baskets)
    items = sorted(set().union(*baskets))
    support = {}
    for k in range(1, len(items) + 1):
        for combo in combinations(items, k):
            cnt = sum(1 for b in baskets if set(combo) <= b)
            if cnt / n >= min_support:
                support[combo] = cnt / n
    rules = {}
    for itemset, s in support.items():
        for k in range(1, len(itemset)):
            for ante in combinations(itemset, k):
                cons = tuple(x for x in itemset if x not in ante)
                conf = s / support[ante]
                if conf >= min_conf:
                    rules[(", ".join(ante), ", ".join(cons))] = (conf, conf / support[cons])
    return support, rules


@pytest.fixture(scope="module")
def items(spark):
    rows = [(o, i) for o, its in ORDERS.items() for i in its]
    return spark.createDataFrame(rows, "OrderNumber string, ProductName string")


def test_itemsets_and_all_split_rules_match_brute_force(items):
    support, rules = brute_force(0.3, 0.5)
    fi = B.frequent_itemsets(B.baskets(items), 0.3)
    got = {tuple(r["items"]): r.support for r in fi.collect()}
    assert got == support
    rr = B.rules_as_text(B.association_rules(fi, 0.5)).collect()
    got_rules = {(r.antecedents, r.consequents): (r.confidence, r.lift) for r in rr}
    assert got_rules.keys() == rules.keys()
    for k, (conf, lift) in rules.items():
        assert got_rules[k][0] == pytest.approx(conf) and got_rules[k][1] == pytest.approx(lift)
    assert any(len(k[1].split(", ")) > 1 for k in got_rules)  # multi-item consequents exist
    for r in rr:
        assert r.support <= min(r.antecedent_support, r.consequent_support) + 1e-12


def test_repeated_items_collapse(items):
    b = {r.OrderNumber: r["items"] for r in B.baskets(items).collect()}
    assert b["o1"] == ["a", "b", "c"]


def test_conviction_infinite_when_certain(spark):
    it = spark.createDataFrame([("o1", "x"), ("o1", "y"), ("o2", "x"), ("o2", "y")],
                               "OrderNumber string, ProductName string")
    rules = B.association_rules(B.frequent_itemsets(B.baskets(it), 0.5), 0.1).collect()
    assert rules and all(r.conviction == float("inf") for r in rules)
    assert all(r.zhangs_metric == 0.0 for r in rules)


def test_long_itemset_needs_no_mask(spark):
    """32 items: levels stop where confidence falls below the threshold."""
    names = [f"i{k:02d}" for k in range(32)]
    rows = [(names, 32, 0.2)] + [([n], 1, 0.9) for n in names]
    rows += [([n for n in names if n != out], 31, 0.4 if out != "i05" else 0.21) for out in names]
    sets = spark.createDataFrame(rows, "items array<string>, Length int, support double")
    found = B.association_rules(sets, 0.9).collect()
    assert [(r.consequent, len(r.antecedent)) for r in found if len(r.antecedent) == 31] == [(["i05"], 31)]
    assert all(r.confidence >= 0.9 for r in found)


def test_no_rules(spark):
    sets = spark.createDataFrame([(["a"], 1, 0.5)], "items array<string>, Length int, support double")
    assert B.association_rules(sets, 0.1).count() == 0


def test_long_itemsets_match_fp_growth(spark):
    """Itemsets of up to six items, equal baskets, rare items, and baskets without any frequent one."""
    from pyspark.ml.fpm import FPGrowth

    rows = [([x for x in "abcdefgh" if (i * 7919 + ord(x) * 31) % (ord(x) - 93) < 3]
             + (["rare%d" % i] if i % 9 == 0 else []),) for i in range(200)] + [([],), (["only"],)]
    df = spark.createDataFrame(rows, "items array<string>")
    got = {tuple(r["items"]): (r.Length, r.Count, r.support) for r in B.frequent_itemsets(df, 0.05).collect()}
    model = FPGrowth(itemsCol="items", minSupport=0.05, minConfidence=1.0).fit(df)
    want = {tuple(sorted(r["items"])): (len(r["items"]), r.freq, r.freq / 202)
            for r in model.freqItemsets.collect()}
    assert got == want and max(map(len, got)) >= 5
    assert not any("rare" in x for k in got for x in k)


def test_equal_baskets_are_mined_as_one_row(spark, monkeypatch):
    """The miner's rows do not grow with the number of equal baskets."""
    seen, real = [], B.cut_lineage

    def counted(df):
        out = real(df)
        seen.append((out.columns, out.count()))
        return out
    monkeypatch.setattr(B, "cut_lineage", counted)
    df = spark.createDataFrame([(list("abc"),), (list("abd"),)] * 50, "items array<string>")
    assert B.frequent_itemsets(df, 0.4).count() == 4 + 5 + 2
    assert max(n for columns, n in seen if "weight" in columns) <= 5


def test_repeated_items_are_refused(spark):
    with pytest.raises(ValueError, match="unique"):
        B.frequent_itemsets(spark.createDataFrame([(["a", "a"],)], "items array<string>"), 0.1)
