"""The manifest against a tree built in memory, for several arities and page heights, with odd rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from filmweave.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf int, tree string, page int, rank int"


def docs(spark, rows):
    """Documents with columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, 1, "t", 2, 3) for r in rows], SCHEMA)


def joined(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    values = (doc_id, source, lang, None if n_chars is None else n_chars + more, text)
    return joined(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([joined(*last[i : i + arity]) for i in range(0, len(last), arity)])
    return levels


def siblings(levels, i, arity):
    out = []
    for level in levels[:-1]:
        run = i // arity * arity
        out.append(("".join(level[run:i]), "".join(level[i + 1 : run + arity])))
        i //= arity
    return out


def brute(rows, arity=2):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in groups[g]], arity) for g in langs}
    top = tree([trees[g][-1][0] for g in langs], arity)
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            proof = siblings(trees[g], i, arity) + siblings(top, k, arity)
            touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            fold = leaf(r, touched)
            for before, after in proof:
                fold = joined(before, fold, after)
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[g][-1][0], root, joined(*(a + b for a, b in proof)), fold, fold == root))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    langs = ["en"] * 6 + ["de", "fr", None, "", "ü"]
    out = [(i, f"text {i} é", rng.choice(langs), rng.choice(["a", "b", None]), rng.choice([i, None])) for i in range(150)]
    out += [(500, None, "en", "a", 1), (501, "", "en", "a", 1), (None, "no id", "en", "a", 2), (None, "no id either", "en", None, None)]
    out += [(3, "text 3 again", "en", "a", 5), (900, "word " * 40000, "zz", "a", 9)]  # one id twice, a group of one
    return out + [(700, "same", "en", "a", 4)] * 70  # equal rows fill whole pages


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_against_a_tree_in_memory(spark, rows, levels, monkeypatch):
    monkeypatch.setattr(merkle.manifest, "__defaults__", (*merkle.manifest.__defaults__[:-1], levels))
    got = [tuple(r) for r in merkle.audit(docs(spark, rows).repartition(7)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize(("arity", "levels"), [(3, 2), (5, 1)])
def test_other_arities(spark, rows, arity, levels):
    found = merkle.manifest(docs(spark, rows), arity=arity, levels=levels)
    got = [tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")), "verified").collect()]
    assert sorted(map(str, got)) == sorted(str((*r[:5], True)) for r in brute(rows, arity))


def test_one_leaf_and_none(spark, rows):
    one = rows[:1]
    got = merkle.audit(docs(spark, one)).collect()
    assert [tuple(r) for r in got] == brute(one)
    assert got[0]["leaf"] == got[0]["subroot"] == got[0]["root"] and got[0]["proof_sha256"] == hashlib.sha256(b"").hexdigest()
    assert merkle.audit(docs(spark, one).limit(0)).count() == 0


def test_ranks_do_not_depend_on_the_layout(spark, rows):
    many = [tuple(r) for r in merkle.audit(docs(spark, rows).repartition(9)).collect()]
    assert sorted(map(str, many)) == sorted(str(tuple(r)) for r in merkle.audit(docs(spark, rows[::-1]).coalesce(1)).collect())


def test_no_python_in_the_plan(spark, rows):
    text = merkle.audit(docs(spark, rows))._jdf.queryExecution().toString()
    assert not [w for w in ("EvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "Cross") if w in text]
