"""The battery of the secret scan against plain Python, and texts with very many matches."""

from __future__ import annotations

import math
import random
import re
import time
from collections import Counter

import pytest

from changetrail.llm import secret_scan
from tests.llm.test_operators import _patterns, documents

B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def normal(z):
    z = max(min(z, 12.0), -12.0)
    return 1 / (1 + math.exp(-1.5976 * z - 0.07056 * z**3))


def battery(token):
    """(class, step, may be random) by the formulas of the docstring."""
    name, _, alphabet, u = next(e for e in secret_scan.ENCODINGS if re.search(e[1], token))
    plain = token.replace("-", "+").replace("_", "/") if name == "base64" else token.lower()
    x = [float(alphabet.find(c)) for c in plain]
    n, k = float(len(x)), float(len(alphabet))
    chi = sum(c * c for c in Counter(x).values()) * k / n - n
    upper = sum(v >= k / 2 for v in x)
    runs = 1 + sum((v >= k / 2) != (w >= k / 2) for v, w in zip(x, x[1:]))
    mean = (k - 1) / 2
    variance = sum((v - mean) ** 2 for v in x)
    lag = sum((v - mean) * (w - mean) for v, w in zip(x, x[1:]))
    df = k - 1
    p_chi = 1 - normal(((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    expected = 1 + 2 * upper * (n - upper) / n
    spread = math.sqrt(max((expected - 1) * (expected - 2) / max(n - 1, 1.0), 1e-9))
    p_runs = 2 * normal(-abs((runs - expected) / spread))
    p_lag = 2 * normal(-abs((lag / variance if variance > 0 else 1.0) * math.sqrt(n)))
    p_text = normal((chi - df - n * u) / math.sqrt(2 * df + 4 * n * u))
    step = min(max(math.floor(-10 * math.log10(max(p_text, 1e-30))), 0), 200)
    level = secret_scan.LEVEL
    return f"{name}:{math.floor(2 * math.log2(n))}", step, p_chi > level and p_runs > level and p_lag > level


def random_spans(texts):
    """The spans of kind random of each text: Benjamini and Hochberg per class over all of them."""
    found = [[(m.start(), m.end(), *battery(m[0])) for m in re.finditer(r"(?<![\w+/-])[\w+/-]{20,}", t, re.A)] for t in texts]
    counts = Counter((c, step if may else 0) for own in found for _, _, c, step, may in own)
    limits = {}
    for kind in {c for c, _ in counts}:
        tested = sum(n for (c, _), n in counts.items() if c == kind)
        for step in sorted({s for c, s in counts if c == kind}):
            above = sum(n for (c, s), n in counts.items() if c == kind and s >= step)
            if 10 ** (-step / 10) * tested <= secret_scan.RATE * above:
                limits[kind] = step
                break
    for text, own in zip(texts, found):
        base = [tuple(map(int, s.split(":")[1:])) for s in _patterns(text).split(",") if s]
        yield [
            f"random:{a}:{b}"
            for a, b, c, step, may in own
            if may and c in limits and step >= limits[c] and not any(s < b and a < e for s, e in base)
        ]


@pytest.fixture(scope="module")
def texts():
    dice = random.Random(6)
    draw = lambda letters, n: "".join(dice.choices(letters, k=n))
    made = []
    for i in range(120):
        pieces = [draw(B64[: dice.choice((26, 52, 62, 64))], dice.randint(12, 70)) for _ in range(dice.randint(0, 6))]
        pieces += ["token=" + draw(B64, 16), draw("0123456789abcdef", 40), "AKIA" + draw(B64[:26], 16), "é𝒳 wörd"] * (i % 3)
        pieces += ["verylongordinarywordofatext" + draw("aeinst", 9), "ABCDEFGH" * 4, "a" * 30, "x/" + draw(B64, 30)]
        dice.shuffle(pieces)
        made.append(dice.choice((" ", "\n", ", ", ":")).join(pieces))
    return [*made, "", "a" * 20, "token=" + "Zb9" * 10 + "é" + draw(B64, 40)]


def test_random_spans_are_those_of_brute_force(spark, texts):
    rows = {r["doc_id"]: r["spans"] for r in secret_scan.scan(documents(spark, texts)).collect()}
    got = [[s for s in rows[i].split(",") if s.startswith("random")] for i in range(len(texts))]
    assert got == list(random_spans(texts))
    assert sum(map(len, got)) > 100


def test_redacted_texts_are_those_of_brute_force(spark, texts, monkeypatch):
    monkeypatch.setattr(secret_scan, "_BLOCK", 7)
    monkeypatch.setattr(secret_scan, "_CHUNK", 3)
    docs = documents(spark, texts)
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.scan(docs).collect()}
    for row in secret_scan.redact(docs).collect():
        text, out, at = texts[row["doc_id"]], "", 0
        for start, end in [tuple(map(int, s.split(":")[1:])) for s in spans[row["doc_id"]].split(",") if s]:
            if start >= at:
                out += text[at:start] + "[SECRET]"
            at = max(at, end)
        assert row["text"] == out + text[at:]


def test_a_text_of_ten_thousand_secrets_takes_seconds(spark, tmp_path):
    dice = random.Random(2)
    draw = lambda n: "".join(dice.choices(B64, k=n))
    text = " ".join("token=" + draw(20) if i % 2 else draw(40) for i in range(10_000))
    documents(spark, [text]).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    began = time.monotonic()
    row = secret_scan.scan(docs).first()
    assert row["n_assign"] == 5000 and row["n_random"] > 4500
    assert secret_scan.redact(docs).first()["text"].count("[SECRET]") == row["n_assign"] + row["n_random"]
    assert time.monotonic() - began < 90


def test_each_pattern_is_tried_once(spark, tmp_path):
    """The optimizer has put no match into a lambda, where it would be looked for once for each token."""
    documents(spark, ["token=abcdefghijklmnop " + B64]).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs")).select("doc_id", "text")
    frame = secret_scan._with_spans(docs, {"base64:12": 1}).select("doc_id", "base", "all_spans")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 4
    assert plan.count("RLIKE") == len(secret_scan.ENCODINGS)
