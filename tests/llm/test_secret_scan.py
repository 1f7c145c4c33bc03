"""Secret scans against a plain scan and a plain window-by-window entropy."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np

from pyspark.sql import functions as F

from tenor.llm import secret_scan as S
from tenor.llm.queries import op12_secret_scan

SF = "/root/testdata/sf0.001"
ASSIGN = r"""(?a:(?i:(password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain_base(text):
    """Every kind by its contract pattern; short matches are dropped after matching."""
    text, out = text or "", []
    for rank, (kind, pattern, group, least) in enumerate((
            ("assign", ASSIGN, 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def plain_entropy(text):
    out = []
    for chars, window, bits in S.CLASSES.values():
        for m in re.finditer(f"[{chars}]{{{window},}}", text):
            for i in range(len(m.group()) - window + 1):
                w = m.group()[i:i + window]
                h = -sum(c / window * math.log2(c / window) for c in Counter(w).values())
                if h >= bits - 1e-9 and re.search("[0-9]", w) and re.search("[A-Za-z]", w):
                    out.append((m.start() + i, m.start() + i + window))
    return S.merged(out)


def fixture():
    rng = random.Random(5)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rand = lambda a, n: "".join(rng.choices(a, k=n))
    texts = [None, "", "token=", "token = 'ab' token: abcdef", 'token="token": "abcdefgh"', "PassWord\"  :   'x.y-z_1",
             "API_KEY=apikey=123456", "toKen=abcdef tokén=abcdef ſecret=abcdef", "AKIA" + "A" * 15, "xAKIA" + rand("ABC012", 16),
             "AKIAAKIA" + rand("XYZ9", 16) + "é", "f" * 24, "é" * 3 + rand("0123456789abcdef", 40), rand("0123456789ABCDEF", 64),
             "id 123e4567-e89b-12d3-a456-426614174000 " + rand(b64, 40), "https://a.example/" + rand(b64[:62], 60) + "?k=" + rand(b64[:62], 40),
             "abcdefghijklmnopqrstuvwxyz0123456789", "losasmentementementemente" * 9, "sha256-" + rand(b64, 44),
             "my" + rand(b64[:62], 20) + "EXAMPLE" + rand(b64[:62], 20), rand(b64, 3000) + " " + rand("ab1", 3000), "a1" * 40000]
    texts += [" ".join(rand(b64 + "=-_.", rng.randint(1, 60)) for _ in range(rng.randint(1, 12))) for _ in range(150)]
    texts += ["".join(rng.choice(["token", "secret", "=", ":", " ", "'", '"', "AKIA", "0af", "Q9", "é", "\n"]) for _ in range(60))
              for _ in range(150)]
    return texts


def test_scan(spark):
    texts = fixture()
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[11], "x"), (3, texts[3], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(5)
    got = S.digest(df).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for i, t in enumerate(texts):
        base, r = plain_base(t), by[i]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), (i, t, r.spans, base)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(b.startswith(k) for b in base) for k in ("assign", "access", "hex")]
        assert [s for s in r.spans.split(",") if s and not s.startswith("entropy")] == base
    assert by[13].spans == "entropy:0:64" and by[16].spans == by[17].spans == by[18].spans == ""
    assert all(not by[i].spans.startswith("entropy:3") for i in (14,)) and "entropy" in by[14].spans
    assert by[15].spans and int(by[15].spans.split(":")[1]) >= 79  # the parameter, not the path
    assert S.digest(df.where("false")).count() == 0


def test_entropy_equals_plain_windows():
    texts = [t or "" for t in fixture()]
    got = S.entropy_spans(texts)
    for t, spans in zip(texts, got):
        assert spans == plain_entropy(t), t[:80]
    assert got == [S.entropy_spans([t])[0] for t in texts]  # neighbours in a batch do not matter


def test_window_sums_are_incremental_counts():
    x = np.random.default_rng(1).integers(65, 75, 500).astype(np.uint8)
    want = [sum(c * math.log2(c) for c in Counter(x[i:i + 24].tolist()).values()) for i in range(477)]
    assert np.allclose(S.window_sums(x, 24) / 2 ** 32, want)


def test_chunks_and_allow_list(spark, monkeypatch):
    texts = [t or "" for t in fixture()]
    whole = S.entropy_spans(texts)
    monkeypatch.setattr(S, "CHUNK", 64)
    assert S.entropy_spans(texts) == whole
    key = "Zx81Kq02Lm93Np47Rs56Tu1A"
    df = spark.createDataFrame([(1, f"see {key} there")], "doc_id long, text string")
    assert S.scan(df).first().spans[0].kind == "entropy" and S.scan(df, allow=[key]).first().spans == []


def test_redact(spark):
    df = spark.createDataFrame([(1, "é token = abcdef0123 end " + "0af1" * 8)], "doc_id long, text string")
    out = S.scan(df).join(df, "doc_id").select(S.redact(F.col("text"), F.col("spans")).alias("t")).first().t
    assert out == "é [secret] end [secret]"


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op12_secret_scan(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        base = plain_base(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("entropy")] == base
