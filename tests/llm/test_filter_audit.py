"""The audit against filters applied one after another, order by order."""

from collections import defaultdict
from itertools import permutations

import numpy as np

from churnkit.llm.filter_audit import audit_filters, orders, removal_steps
from tests.llm.samples import SCHEMA, some_rows, table


def fails(text, earlier):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    out = set()
    if len(words) < 200:
        out.add("A")
    if 100 * len(set(words)) < 50 * len(words):
        out.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text):
        out.add("C")
    if set("#$%&*|") & set(text):
        out.add("D")
    if earlier:
        out.add("E")
    return out


def expected(rows, labels):
    """rows of (doc_id, text, source); labels of (doc_id, quality, toxic)."""
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    parts = defaultdict(list)
    for doc_id, text, source in rows:
        failed = fails(text or "", doc_id is not None and least[text or ""] < doc_id)
        good = doc_id is not None and any(i == doc_id and q == 1 for i, q, _ in labels)
        toxic = doc_id is not None and any(i == doc_id and t == 1 for i, _, t in labels)
        parts[source or ""].append((failed, good, toxic))
    out = []
    for part, docs in parts.items():
        shapley, steps = defaultdict(int), []
        for order in permutations("ABCDE"):
            left = docs
            for s, f in enumerate(order):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                all_failed = sum(f in d[0] for d in docs)
                alone = sum(d[0] == {f} for d in docs)
                shapley[f] += len(gone)
                steps.append((part, "".join(order), s + 1, len(left), len(gone), all_failed - len(gone) - sum(f in d[0] for d in left), alone,
                              sum(d[1] for d in gone), sum(d[2] for d in gone), f))
        out += [(*row[:-1], shapley[row[-1]]) for row in steps]
    return sorted(out)


def audited(df):
    names = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return sorted(tuple(r[n] for n in names) for r in df.collect())


LABELS = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 90, 3)] + [(3, None, 1), (3, 1, None), (None, 1, 1), (600, 1, 0), (9999, 1, 1)]


def test_every_order_is_that_of_filters_applied_in_turn(spark):
    rows = some_rows(n=90) + [(800 + i, "Same TEXT | in many documents " * 40) for i in range(50)] + [(None, None), (7, "word " * 300)]
    full = [(i, t, None, None if i == 5 else f"s{0 if i is None or i % 3 else i % 2}", None, *["z"] * 10) for i, t in rows]
    docs = spark.createDataFrame(full, SCHEMA)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    wanted = expected([(r[0], r[1], r[3]) for r in full], LABELS)
    assert audited(audit_filters(docs, labels)) == wanted
    assert len(wanted) == 600 * len({r[3] or "" for r in full}) and any(r[4] and r[5] for r in wanted)


def test_tables_without_sources_labels_or_rows(spark):
    docs = table(spark, [(1, "few words"), (2, "few words"), (None, "few words")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    wanted = expected([(1, "few words", None), (2, "few words", None), (None, "few words", None)], [])
    assert audited(audit_filters(docs.drop("source"), none)) == wanted
    assert audit_filters(docs.where("doc_id = 7"), none).collect() == []


def test_the_product_gives_the_least_place():
    order = orders(4)
    steps = removal_steps(order)
    assert steps.shape == (24, 16)
    for o, row in zip(order.tolist(), steps):
        for mask, step in enumerate(row):
            places = [o.index(f) for f in range(4) if mask >> f & 1]
            assert step == min(places, default=99)
    assert (np.sort(order, axis=1) == np.arange(4)).all()
