"""The filter audit against a brute-force simulation of every order."""

from __future__ import annotations

import itertools
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rollforge.llm import filter_audit

COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def simulate(docs, labels):
    """docs: (doc_id, text, source); every order applied filter by filter."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    fails = defaultdict(list)
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and first[text] < i,
        }
        fails[source or ""].append((i, {c for c, f in failed.items() if f}))
    out = {}
    for part, rows in fails.items():
        shapley = defaultdict(int)
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, c in enumerate(order, 1):
                gone = [r for r in left if c in r[1]]
                left = [r for r in left if c not in r[1]]
                shapley[c] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(c in r[1] for r in rows) - len(gone), sum(r[1] == {c} for r in rows),
                    sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def found(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS] for r in df.collect()}


LONG = " ".join(f"w{i}" for i in range(60))
DOCS = [
    (5, LONG, "a"), (2, LONG, "b"), (9, LONG, "a"), (9, LONG, "a"), (None, LONG, "a"), (1, None, "a"), (3, "", None), (4, "", ""),
    (6, "SHOUT " * 60, "b"), (7, "x# " * 60, "b"), (8, " \t\r\n", "b"), (10, "é" * 300_000, "c"), (11, LONG + " $", None),
]
LABELS = [(5, 1, 0), (9, 1, 1), (9, 0, 0), (6, 0, 1), (None, 1, 1), (77, 1, 1)]


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(*d, 1, "x") for d in DOCS], "doc_id long, text string, source string, n long, bits string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert found(filter_audit.audit(docs, labels)) == simulate(DOCS, LABELS)
    assert filter_audit.audit(docs.where("false"), labels).count() == 0


@pytest.mark.parametrize("copies", [3_000])
def test_hot_text(spark, copies):
    rows = [(i, "same text" if i % 2 else f"text {i}", "s") for i in range(copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    result = filter_audit.audit(docs, labels, {"A": F.lit(False)}).where("filter_order = 'EA' and step = 1").first()
    assert (result["removed"], result["kept"], result["shapley"]) == (copies // 2 - 1, copies // 2 + 1, 2 * (copies // 2 - 1))


def test_null_conditions_and_own_filters(spark):
    docs = spark.createDataFrame([(1, "a", "s"), (2, None, "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int")
    rows = filter_audit.audit(docs, labels, {"N": F.col("text") == "", "O": F.lit(None).cast("boolean")})
    assert rows.count() == 6 * 3
    assert rows.where("filter_order = 'NOE' and step = 1").first()["good_lost"] == 1
