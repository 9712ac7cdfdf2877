"""Association rules against brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from annolink.operators.rules import association_rules, strong_rules


def brute(tx, support, confidence):
    docs = {}
    for d, i in tx:
        docs.setdefault(d, set()).add(i)
    items = {i for _, i in tx}
    n = {i: sum(i in s for s in docs.values()) for i in items}
    rules = {}
    for a in items:
        for b in items - {a}:
            both = sum(a in s and b in s for s in docs.values())
            if both and both / len(docs) >= support and both / n[a] >= confidence:
                rules[a, b] = (both, both / len(docs), both / n[a], both * len(docs) / (n[a] * n[b]))
    return rules


def found(spark, tx, support, confidence):
    df = spark.createDataFrame(tx, "doc_id string, item string")
    rows = association_rules(df, support, confidence).collect()
    assert len({(r["lhs"], r["rhs"]) for r in rows}) == len(rows)
    return {
        (r["lhs"], r["rhs"]): (r["n_both"], r["support"], r["confidence"], r["lift"]) for r in rows
    }


def same(a, b):
    return a.keys() == b.keys() and all(
        all(abs(x - y) < 1e-9 for x, y in zip(a[k], b[k])) for k in a
    )


pairs = st.lists(
    st.tuples(st.sampled_from([f"d{i}" for i in range(14)]), st.sampled_from("abcdefg")),
    min_size=1, max_size=70,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs, st.sampled_from([0.0001, 0.1, 0.3]), st.sampled_from([0.2, 0.5, 0.75, 0.95, 1.0]))
def test_rules_equal_brute_force(spark, tx, support, confidence):
    assert same(found(spark, tx, support, confidence), brute(tx, support, confidence))


def test_large_document_and_exact_threshold(spark):
    # 'a' occurs with 'b' in exactly 95 of 100 documents; one document holds all items.
    tx = [(f"d{i}", "a") for i in range(100)] + [(f"d{i}", "b") for i in range(95)]
    tx += [(f"d{i}", "c") for i in range(50)] + [("d0", f"x{j}") for j in range(60)]
    got = found(spark, tx, 0.0001, 0.95)
    assert same(got, brute(tx, 0.0001, 0.95))
    assert ("a", "b") in got and ("c", "a") in got


def test_strong_rules(spark):
    tx = [(f"d{i}", "a") for i in range(50)] + [(f"d{i}", "b") for i in range(10)]
    df = spark.createDataFrame(tx, "doc_id string, item string")
    rules = association_rules(df, 0.0001, 0.95)
    assert [(r["lhs"], r["rhs"]) for r in strong_rules(rules, 0.2).collect()] == [("b", "a")]
    assert strong_rules(rules, 0.21).count() == 0


def test_a_document_with_all_items_at_a_low_confidence(spark):
    """400 items, one document has them all: no pairs of that document are looked at, none is lost."""
    items = [f"i{j:03}" for j in range(400)]
    tx = [("all", i) for i in items]
    tx += [(f"d{j}_{k}", items[j]) for j in range(400) for k in range(6)]
    tx += [(f"d{j}_{k}", items[(j + 1) % 400]) for j in range(0, 400, 10) for k in range(3)]
    got = found(spark, tx, 0.0001, 0.3)
    want = brute(tx, 0.0001, 0.3)
    assert same(got, want) and len(want) == 80
    made = rows_made(association_rules(spark.createDataFrame(tx, "doc_id string, item string"), 0.0001, 0.3))
    assert made < 159_600 / 10


def rows_made(df):
    """The largest number of rows that a join of the plan gives, when it has run."""
    df.collect()
    plans, most = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        node = plans.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            node = node.executedPlan()
            plans.append(node)
            continue
        metrics = node.metrics()
        if "Join" in name and metrics.contains("numOutputRows"):
            most = max(most, metrics.apply("numOutputRows").value())
        children = node.children()
        plans += [children.apply(i) for i in range(children.size())]
        if name.endswith("QueryStage"):
            plans.append(node.plan())
    return most
