"""Methods that SQL can't express, against plain versions: risk gradient, string kernel, regression by sums, template tree."""

import math
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from filmweave.llm import licenses, quality, templates, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)


def softplus(z):
    return np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0)


@pytest.mark.parametrize("prior", [0.3, 0.97])
def test_the_gradient_is_that_of_the_non_negative_risk(prior):
    rng = np.random.default_rng(2)
    p, u = rng.normal(0.7, 1, (40, 5)), rng.normal(0, 1, (60, 5))
    decay = 1e-2

    def parts(theta):
        zp, zu = p @ theta, u @ theta
        return prior * softplus(-zp).mean(), softplus(zu).mean() - prior * softplus(zp).mean()

    signs = set()
    for _ in range(40):
        theta = rng.normal(size=5) * 2
        up, negative = parts(theta)
        signs.add(negative >= 0)
        # Below zero the negative part is climbed back and the rest waits.
        value = (lambda t: sum(parts(t))) if negative >= 0 else (lambda t: -parts(t)[1])
        slope = [(value(theta + h) - value(theta - h)) / 2e-6 for h in np.eye(5) * 1e-6]
        slope[:-1] += decay * theta[:-1]
        assert np.allclose(quality.risk_gradient(theta, p, u, prior, decay), slope, atol=1e-6)
    assert prior < 0.5 or signs == {True, False}


def plain_kernel(a, b):
    """Gapped triples of both words, one by one."""

    def features(word):
        symbols = [toxicity._EDGE, *toxicity._symbols(np.array([ord(c) for c in word], np.int64)).tolist(), toxicity._EDGE]
        out = {}
        for i, j, k in combinations(range(len(symbols)), 3):
            if k - i < toxicity.SPAN and symbols[i] and symbols[j] and symbols[k]:
                key = (symbols[i], symbols[j], symbols[k])
                # Each occurrence is a feature of its own in the norm, as in the operator.
                out.setdefault(key, []).append(toxicity.DECAY ** (k - i + 1))
        return out

    fa, fb = features(a), features(b)
    norm = lambda f: math.sqrt(sum(w * w for ws in f.values() for w in ws)) or 1.0
    return sum(sum(fa[t]) * sum(fb[t]) for t in fa.keys() & fb.keys()) / (norm(fa) * norm(fb))


def test_the_kernel_is_that_of_all_gapped_triples():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdé*9-", k=rng.randint(1, 12))) for _ in range(60)] + ["blockhead", "block*head", "bl.ock"]
    landmarks = ["blockhead", "abab", "dcba", "é", "aaaaaa"]
    got = toxicity.kernel(words, landmarks)
    want = np.array([[plain_kernel(a, b) for b in landmarks] for a in words])
    assert np.allclose(got, want, atol=1e-9)


def test_regression_sums_are_those_of_the_model(spark):
    model = licenses.train()
    rng = random.Random(4)
    statements = [t for _, t in licenses.TEMPLATES]
    lines = [*statements, *(" ".join(rng.sample(t.split(), max(3, len(t.split()) - 2))) for t in statements), "nothing of the kind here"]
    found = licenses.license_paragraphs(docs(spark, ["\n".join(lines)]), model).collect()
    got = {r["paragraph"]: (r["family"], r["probability"], r["cover"]) for r in found}
    usable, want = set(model.grams), {}
    for at, line in enumerate(lines):
        own = licenses.grams_of(licenses.words_of(line))
        hits = [i for i, g in enumerate(model.grams) if g in own]
        if not hits:
            continue
        z = (model.weights[hits].sum(axis=0) + model.bias) / model.temperature
        share = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        family = model.families[int(share.argmax())]
        if family != licenses.UNKNOWN and share.max() >= licenses.THRESHOLD:
            patterns = [licenses.grams_of(licenses.words_of(t)) & usable for f, t in licenses.TEMPLATES if f == family]
            want[at] = (family, share.max(), max(len(own & p) / len(p) for p in patterns))
    assert set(got) == set(want) and len(want) > 10
    for at, (family, probability, cover) in want.items():
        assert got[at][0] == family and abs(got[at][1] - probability) < 1e-9 and abs(got[at][2] - cover) < 1e-9


def plain_tree(texts, least=templates.LEAST_DOCUMENTS, variable=templates.VARIABLE):
    """The template tree over lines held in memory."""
    wild = lambda line: tuple(templates.WILDCARD if any(c.isdigit() for c in t) else t for t in line.split())
    needed = lambda size: min(least, max(2, math.ceil(templates.WEIGHT / size)))
    enough = lambda literal, size: literal >= 2 or 2 * literal >= size
    holders, exact = {}, {}
    for text in set(texts):
        for line in filter(str.strip, text.split("\n")):
            holders.setdefault(wild(line), set()).add(text)
            if templates.WILDCARD in wild(line):
                exact.setdefault(line, set()).add(text)
    gone = set()
    leaves = {}
    for line, held in holders.items():
        literal = sum(t != templates.WILDCARD for t in line)
        if enough(literal, len(line)) and len(held) >= needed(max(literal, 1)):
            gone.add(line)
        leaves.setdefault((len(line), line[: templates.DEPTH]), []).append(line)
    for lines in leaves.values():
        if sum(len(holders[x]) for x in lines) < least:
            continue
        counts = {}
        for line in lines:
            for at, token in enumerate(line):
                counts[at, token] = counts.get((at, token), 0) + len(holders[line])
        rung = lambda at, token: math.floor(math.log(counts[at, token] / least, templates.STEP) + 1e-9)  # noqa: B023, E731
        found = {}
        for line in lines:
            kept = [(at, t, rung(at, t)) for at, t in enumerate(line) if t != templates.WILDCARD and counts[at, t] >= least]
            words = sum(t != templates.WILDCARD for t in line)
            for bar in range(max((r for _, _, r in kept), default=-1) + 1):
                own = tuple((at, t) for at, t, r in kept if r >= bar)
                if len(own) >= (1 - variable) * words and enough(len(own), len(line)):
                    found.setdefault((bar, own), set()).add(line)
        for members in found.values():
            if len(set().union(*(holders[x] for x in members))) >= least:
                gone |= members
    often = {line for line, held in exact.items() if len(held) >= needed(len(line.split()))}
    return ["\n".join(x for x in t.split("\n") if not (x.strip() and wild(x) in gone) and x not in often) for t in texts]


def test_the_tree_is_that_of_a_plain_version(spark):
    rng = random.Random(5)
    names = ["ann", "bob", "cy", "di", "ed", "fay", "gil", "hal"]
    shapes = ["User {} logged in from {} at once today", "Page {n} of {n}", "{} {}", "Copyright {n} by {}", "the end", "{n}", "a b c {} {} {} f g"]
    long_line = " ".join(f"{x}{y}" for x in "abcdefgh" for y in "ijklmno")
    texts = []
    for _ in range(160):
        lines = []
        for _ in range(rng.randint(0, 6)):
            shape = rng.choice(shapes)
            while "{n}" in shape:
                shape = shape.replace("{n}", str(rng.randint(1, 4)), 1)
            while "{}" in shape:
                shape = shape.replace("{}", rng.choice(names), 1)
            lines.append(rng.choice(["", shape, shape, shape + rng.choice(["", "", " " + rng.choice(names)])]))
        if rng.random() < 0.02:
            lines.append(long_line)
        texts.append("\n".join(lines))
    texts += texts[:20]
    got = {r["doc_id"]: r["text"] for r in templates.drop_recurring(docs(spark, texts)).collect()}
    want = plain_tree(texts)
    assert [got[i] for i in range(len(texts))] == want and any(w != t for w, t in zip(want, texts)) and any(w for w in want)
    assert docs(spark, texts).agg(F.count("*")).first()[0] == 180
