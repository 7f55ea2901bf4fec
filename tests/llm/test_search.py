"""Personal data, clusters and lexical search against brute force, over awkward rows."""

import hashlib
import math
import re
import time

import numpy as np
import pytest

from cadenza.llm import clusters, lexical, personal

RANDOM = np.random.default_rng(11)
DOCS = "doc_id long, text string, source string, n_chars int, spans string, rank int, item_id long, segment int"


def _documents(spark, rows):
    return spark.createDataFrame([(i, t, "s", None if t is None else len(t), "x", 1, 2, 3) for i, t in rows], DOCS)


# --- personal data


def _by_regex(text):
    found = []
    for kind, name in enumerate(personal.KINDS):
        for m in re.finditer(personal.PATTERNS[name], text):
            own = m.group(m.lastindex or 0)
            digits = re.sub("[^0-9]", "", own)
            odd = [int(c) for c in digits[::-1]]
            ok = {
                "ip": lambda o: all(int(p) <= 255 for p in o.split(".")),
                "card": lambda o: 14 <= len(digits) <= 19 and (sum(odd[::2]) + sum(sum(divmod(2 * x, 10)) for x in odd[1::2])) % 10 == 0,
                "phone": lambda o: 10 <= len(digits) <= 15,
                "iban": lambda o: int("".join(str(int(c, 36)) for c in (o.replace(" ", "")[4:] + o.replace(" ", "")[:4]))) % 97 == 1,
                "account": lambda o: 6 <= len(o) <= 17,
            }.get(name, lambda o: True)
            if ok(own):
                found.append((m.start(m.lastindex or 0), kind, m.end(m.lastindex or 0)))
    return sorted(found)


KNOWN = [
    "mail a.b+c@host-1.example.com, or x@y, p@q@r.st", "a@b.c@d.e", "10.0.0.1 1.2.3.4.5.6.7.8.9 256.1.1.1 1.2.3 0000255.0.0.0 1..2.3.4.5", "4111 1111 1111 1111 and 4111-1111-1111-1112, 5500005555555559",
    "+1 (415) 555-0100 +12 +49 30 1234567 +", "see https://example.org/a?b=c. ftp://x http:// (http://a.b/c)", "IBAN: DE89370400440532013000 iban GB29 NWBK 6016 1331 9268 19 IBAN DE00370400440532013000",
    "account number: 12345678 acct#12345 Account 123456789012345678 ACCOUNT:999999", "é@é.com ünï@dom.ain 😀a@b.cd", "0 0 0 0-0-0-0 0000000 0", "",
]


def test_personal_equals_regular_expressions():
    alphabet = list("0123456789") * 2 + list("  --..++@@()") + list("aZ%_é") + ["http://", "IBAN ", "acct ", "4111111111111111", "10.1.2.3"]
    texts = KNOWN + ["".join(RANDOM.choice(alphabet, RANDOM.integers(1, 60))) for _ in range(4000)]
    for text in texts:
        assert personal.personal_spans(text) == _by_regex(text), text


def test_personal_checks():
    spans = {k: [] for k in personal.KINDS}
    for text in KNOWN:
        for a, k, b in personal.personal_spans(text):
            spans[personal.KINDS[k]].append(text[a:b])
    assert spans["iban"] == ["DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19"]
    assert spans["account"] == ["12345678", "999999"]
    assert {"4111 1111 1111 1111", "5500005555555559"} < set(spans["card"]) and "4111-1111-1111-1112" not in spans["card"]
    assert "+1 (415) 555-0100" in spans["phone"] and "+12 +" not in spans["phone"]


def test_personal_is_linear_in_long_texts():
    began = time.perf_counter()
    assert personal.personal_spans("a" * 3_000_000 + "@b.cd") == [(0, 0, 3_000_005)]
    assert len(personal.personal_spans("1.2.3.4 " * 200_000)) == 200_000
    assert personal.personal_spans("x@" * 500_000) == []
    assert personal.personal_spans("9" * 2_000_000) == []
    assert time.perf_counter() - began < 30


def test_personal_rows(spark):
    rows = [(1, None), (2, ""), (3, KNOWN[0]), (3, KNOWN[0]), (None, KNOWN[1]), (5, " ".join(KNOWN) * 300)]
    found = personal.scan(_documents(spark, rows)).collect()
    assert sorted((r["doc_id"] or -1) for r in found) == [-1, 1, 2, 3, 3, 5]
    by_id = {r["doc_id"]: r for r in found}
    for i, t in rows:
        spans = _by_regex(t or "")
        said = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        base = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in spans if k < personal.BASE)
        assert by_id[i]["spans"] == said and by_id[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert by_id[i]["n_email"] == sum(k == 0 for _, k, _ in spans)
    assert personal.scan(_documents(spark, []).limit(0)).collect() == []


def test_personal_redaction(spark):
    rows = [(1, "to a@b.cd from 10.0.0.1"), (2, None), (3, "clean"), (None, "a@b.cd"), (1, "to a@b.cd from 10.0.0.1"), (4, "http://u@h.org/x end")]
    df = _documents(spark, rows)
    out = personal.redact(df)
    assert out.columns == df.columns
    got = sorted((r["doc_id"] or -1, r["text"] or "", r["n_chars"] or 0, r["spans"]) for r in out.collect())
    assert got == sorted([(-1, "[EMAIL]", 7, "x"), (1, "to [EMAIL] from [IP]", 20, "x"), (1, "to [EMAIL] from [IP]", 20, "x"), (2, "", 0, "x"), (3, "clean", 5, "x"), (4, "[URL] end", 9, "x")])


# --- clusters


def _lloyd(rows, k, rounds):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, np.array([min(max(math.floor(64 * float(x)), -(2**27)), 2**27) for x in e], object)))
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v.tolist()) for i, v in kept if i is not None)
    centres = [np.array(v, object) for _, v in named[:k]]
    nearest = lambda v: min((int(((v - c) ** 2).sum()), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(centres)):
            members = [v for (_, v), o in zip(kept, own, strict=True) if o == j]
            if members:
                centres[j] = sum(members) // len(members)
    last = [nearest(v) for _, v in kept]
    whole = sum(d for d, _ in last)
    return sorted((i if i is not None else -1, j, d, sum(x for x, y in last if y == j), whole, hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest()) for (i, _), (d, j) in zip(kept, last, strict=True))


def _clustered(spark, rows, **more):
    df = spark.createDataFrame([(i, e, 1, 2, "z") for i, e in rows], "vec_id long, embedding array<float>, label int, cluster int, upper string").repartition(3)
    return sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in clusters.cluster(df, **more).collect())


def _vector(scale=1.0):
    return [float(np.float32(x)) for x in RANDOM.normal(0, scale, 64)]


def test_clusters_equal_plain_rounds(spark):
    far = [[float(c)] * 64 for c in range(5)]
    rows = [(i, [float(np.float32(x + y)) for x, y in zip(far[i % 5], _vector(0.3), strict=True)]) for i in range(300)]
    same = _vector()
    rows += [(400 + i, same) for i in range(30)] + [(400, same), (None, same), (500, None), (501, same[:63]), (502, [*same[:63], None]), (503, [*same[:63], float("nan")]), (504, [*same[:63], float("inf")]), (505, []), (506, [3e38] * 64)]
    assert _clustered(spark, rows) == _lloyd(rows, 16, 3)
    assert _clustered(spark, rows[:120], k=40, rounds=6) == _lloyd(rows[:120], 40, 6)


def test_clusters_with_ties(spark):
    """Components of -1, 0 and 1 make many equal distances."""
    rows = [(i, [float(x) / 64 for x in RANDOM.integers(-1, 2, 64) * (np.arange(64) < 4)]) for i in range(200)]
    assert _clustered(spark, rows) == _lloyd(rows, 16, 3)


def test_clusters_of_few_rows(spark):
    assert _clustered(spark, [(7, _vector())])[0][:3] == (7, 0, 0)
    assert _clustered(spark, [(None, _vector()), (1, None)]) == []


def test_bounds_spare_distances():
    x = np.concatenate([RANDOM.normal(c * 400, 30, (500, 64)) for c in range(16)]).astype(np.int64)
    centres = x[::500].copy()
    tool = clusters.Yinyang(centres, clusters.groups_of(centres))
    cluster, upper, lower = tool.first(x)
    drift = np.full(16, 1.0)
    upper, lower = tool.moved(upper, lower, cluster, drift)
    again, _, _, used = tool.again(x, cluster.copy(), upper, lower)
    assert (again == cluster).all() and used < len(x)


# --- lexical search

_fold = str.maketrans(lexical.UPPER, lexical.LOWER)


def _terms(text):
    return re.findall(lexical.TERM, (text or "").translate(_fold))


def _ranked(docs, items, best=10):
    known = [(i, t) for i, text in docs if i is not None and (t := _terms(text))]
    n, length = len(known), sum(len(t) for _, t in known)
    df = {}
    for _, t in known:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    texts = {}
    for i, text in items:
        if i is not None and text is not None:
            texts[i] = min(texts.get(i, text), text)
    for i, text in texts.items():
        asked = _terms(text)
        scores = []
        for d, t in known:
            m = 25 + 75 * len(t) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (1_000_000_000 * t.count(x) // (1000 * t.count(x) + 8 * m)) for x in asked if x in df and x in t)
            if score:
                scores.append((-score, d))
        out += [(i, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scores)[:best])]
    return sorted(out)


def _searched(spark, docs, items, **more):
    questions = spark.createDataFrame([(i, t, 5, "q") for i, t in items], "item_id long, text string, rank int, term string")
    return sorted(tuple(r) for r in lexical.search(_documents(spark, docs).repartition(3), questions, **more).select("item_id", "rank", "doc_id", "score").collect())


def _prose(n, vocabulary=60):
    return " ".join(f"w{int(x)}" for x in RANDOM.zipf(1.4, n) % vocabulary)


@pytest.fixture(scope="module")
def prose():
    docs = [(int(i), _prose(int(RANDOM.integers(1, 40)))) for i in RANDOM.permutation(400)]
    docs += [(1000 + i, "same words here w1") for i in range(40)]  # ties
    docs += [(2000, None), (2001, ""), (2002, " .,; "), (None, "w1 w2 lost"), (3, "w5 w6 repeated"), (3, "w5 w6 repeated"), (2003, _prose(30_000)), (2004, "Ünïcode ÉÉ naïve_café 漢字, w1;W2\x00w3")]
    return docs


QUESTIONS = [(i, _prose(20)) for i in range(12)] + [(20, "same words here"), (21, "nothing known zzz"), (22, ""), (23, None), (None, "w1"), (24, "w1 w1 w1 W1 w2"), (25, "naïve café 漢字 ünïcode Ünïcode"), (26, "w7"), (26, "w6"), (27, "repeated")]


def test_search_equals_brute_force(spark, prose):
    want = _ranked(prose, QUESTIONS)
    assert _searched(spark, prose, QUESTIONS) == want
    assert _searched(spark, prose, QUESTIONS, segment_mb=0.002, segment_docs=50, per_block=3) == want


def test_search_of_empty_tables(spark, prose):
    assert _searched(spark, [(1, None)], QUESTIONS) == []
    assert _searched(spark, prose[:20], [(None, "w1")]) == []
    assert lexical.search(_documents(spark, prose[:3]).limit(0), _documents(spark, [(1, "x")]).select("item_id", "text")).collect() == []


def test_tree_opens_little_and_keeps_ties():
    docs = np.repeat(np.arange(4096), 2)
    terms = np.tile([0, 1], 4096)
    values = np.ones(8192, np.int64)
    values[2 * 777], values[2 * 3000] = 50, 50
    tree = lexical.MaxTree(docs, terms, values, 4096, 2)
    opened = []
    plain = tree.bounds
    tree.bounds = lambda level, *a: opened.append(level) or plain(level, *a)
    assert tree.search(np.array([1, 1]), 4) == [(777, 51), (3000, 51), (0, 2), (1, 2)]
    assert len(opened) < 30
