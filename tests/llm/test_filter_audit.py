"""The filter audit against its SQL, against plain counting, and on odd rows."""

import itertools
import random

from kaigi.llm import filter_audit, queries
from tests.compare import same_rows

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, part string, mask int, good boolean, n long, digest string, first boolean"
LABELS = "doc_id long, quality int, toxic int, good string"


def plain(rows, labels):
    """Every order applied to every document."""
    marks = {}
    for d, q, t, *_ in labels:
        a, b = marks.get(d, (False, False))
        marks[d] = (a or q == 1, b or t == 1)
    docs = []
    for d, text, lang, *_ in rows:
        t = text or ""
        ws = [w for w in t.translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
        copy = d is not None and any((x or "") == t and o is not None and o < d for o, x, *_ in rows)
        fails = {"A": len(ws) < 100, "B": 100 * len(set(ws)) < 80 * len(ws), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t), "E": copy}
        docs.append((lang or "", fails, *(marks.get(d, (False, False)) if d is not None else (False, False))))
    out, totals = {}, {}
    for part in {x[0] for x in docs}:
        own = [x for x in docs if x[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[1][f]]
                left = [x for x in left if not x[1][f]]
                failing = sum(x[1][f] for x in own)
                alone = sum(x[1][f] and sum(x[1].values()) == 1 for x in own)
                out[part, "".join(order), step] = [len(left), len(gone), failing - len(gone), alone, sum(x[2] for x in gone), sum(x[3] for x in gone), f]
                totals[part, f] = totals.get((part, f), 0) + len(gone)
    return sorted((*k, *v[:6], totals[k[0], v[6]]) for k, v in out.items())


def test_sql(spark):
    assert len(same_rows(spark, queries.queries()["op13_filter_audit"], queries.oracle_sql()["op13_filter_audit"], SF)) % 600 == 0


def test_odd_rows(spark):
    r = random.Random(3)
    long = " ".join(f"w{i}" for i in range(150))
    texts = [None, "", " \n\t", long, long, long + " $", "A" * 40, "a b " * 80, "é" * 9 + "B", "x y " * 100, "w\x1cz " * 120, " ".join(f"v{i}" for i in range(200_000)), "a&b"]
    rows = [(i, t, [None, "en", "", "fr"][r.randrange(4)], "p", 1, True, 2, "d", False) for i, t in enumerate(texts + texts[:6])]
    rows += [rows[3], rows[3], (None, long, "en", None, None, None, None, None, None), (None, long, None, None, None, None, None, None, None), (3, long, "fr", None, None, None, None, None, None)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None]), "g") for i in range(15)] + [(3, 1, 0, None), (3, 0, 1, None), (None, 1, 1, None)]
    found = filter_audit.audit(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS))
    assert sorted(map(tuple, found.collect())) == plain(rows, labels)


def test_without_documents(spark):
    assert filter_audit.audit(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)).collect() == []


def test_shapley_is_the_mean_over_orders():
    r = random.Random(1)
    counts = {m: r.randrange(50) for m in range(32)}
    p = filter_audit.removal_polynomial(counts)
    removes = lambda on: sum(n for m, n in counts.items() if m & on)
    assert all(filter_audit.corner(p, on) == removes(on) for on in range(32))
    for i in range(5):
        total = 0
        for order in itertools.permutations(range(5)):
            before = sum(1 << j for j in order[: order.index(i)])
            total += removes(before | 1 << i) - removes(before)
        assert filter_audit.shapley(p, 1 << i) * 120 == total
