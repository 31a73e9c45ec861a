"""The operators on documents against brute force, with odd rows and an empty table."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomgraph.llm import fingerprints, language_id, lm_scoring, mixing, near_dedup, packing, pii, suffix_dedup, window_dedup
from loomgraph.llm import _shared as shared
from loomgraph.llm._shared import shingle_set, words


def collect(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_word_hashes(monkeypatch):
    rng = np.random.default_rng(1)
    parts = ["a", "B", "ab", "BA", "é", "É", "\x85", "\xa0", "x" * 50, " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1f", "文"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 60))) for _ in range(800)]
    seen = {}
    for t in texts:
        h = shared.word_hashes(t).tolist()
        assert len(h) == len(words(t))
        for w, x in zip(words(t), h):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen) > 500
    monkeypatch.setattr(shared, "BLOCK_BYTES", 7)
    assert all(shared.word_hashes(t).tolist() == [seen[w] for w in words(t)] for t in texts)


# -- packing ---------------------------------------------------------------------------


def test_packing_round_trip(docs, nothing):
    encode = packing.ids_of(packing.default_vocabulary())
    got = packing.pack(docs, group_bytes=20000).collect()
    seqs = collections.defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == r.length > 0
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= 2048
    by = collections.Counter()
    for r in got:
        by[r.doc_id, r.start, tuple(r.ids), r.doc_tokens] += 1
    want = collections.Counter()
    for d, t in collect(docs, "doc_id", "text"):
        ids = [*encode.whole.encode(t or "", add_special_tokens=False).ids, 1]
        tie = zlib.crc32(np.array(ids, "<u4").tobytes())
        for s, n in packing.cuts(len(ids), piece=512 if tie % packing.FINE_EVERY else packing.FINE):
            want[d, s, tuple(ids[s : s + n]), len(ids)] += 1
    assert by == want
    assert packing.pack(nothing).count() == 0
    again = packing.pack(docs.repartition(5), group_bytes=20000, payload=packing.CRC)
    assert sorted(collect(again, "sequence_id", "offset", "length")) == sorted((r.sequence_id, r.offset, r.length) for r in got)


@pytest.mark.parametrize("text", ["ΑΣΣ ΟΔΟΣ.", "İstanbul", "a.. b,. c.,", "don't I'LL x's. 's", "é .́x", "\x1c\x1d a\x85b", "文字.文字。", "<|endoftext|> x.", "", "..."])
def test_ids_are_the_tokenizers(text):
    e = packing.ids_of(packing.default_vocabulary())
    assert e(text).tolist() == e.whole.encode(text, add_special_tokens=False).ids


def test_ids_of_random_strings():
    e = packing.ids_of(packing.default_vocabulary())
    parts = [*"abcXYZ019__.,.,    \n\t\r'-!?(", "'s", "'ll", "İ", "É", "é", "ß", "J̌", "½", "²", "文", "。", "ا", "́", "\u00a0", "\x85", "Σ", "😀"]
    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(parts, rng.integers(1, 15))) for _ in range(20000)] + ["foo_, bar_. baz"]
    want = e.whole.encode_batch(texts, add_special_tokens=False)
    assert all(e(t).tolist() == w.ids for t, w in zip(texts, want))


def test_ids_of_whole_documents(spark):
    e = packing.ids_of(packing.default_vocabulary())
    texts = [t for t, in collect(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "text") if t]
    assert all(e(t).tolist() == w.ids for t, w in zip(texts, e.whole.encode_batch(texts, add_special_tokens=False)))


@pytest.mark.parametrize("n", [1, 2, 7, 200])
def test_windows(n):
    rng = np.random.default_rng(n)
    sizes = rng.integers(1, 512, n)
    w = packing.windows(sizes)
    assert sorted(i for x in w for i in x) == list(range(n))
    sums = [int(sizes[x].sum()) for x in w]
    assert max(sums) <= 2048 and len(w) <= -(-int(sizes.sum()) // 2048) * 1.1 + 2
    sums, _ = packing.difference(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(sums.tolist()) == [14, 16]  # the known outcome of differencing


# -- near duplicates ----------------------------------------------------------------------


def components(rows, percent=75):
    sets = [set(shingle_set(t).tolist()) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [(d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(rows)], [find(i) if sets[i] else -1 - i for i in range(len(rows))]


def test_near_duplicates(docs, nothing):
    rows = collect(docs, "doc_id", "text")
    got = collect(near_dedup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept")
    key = lambda r: tuple(-1 if x is None else x for x in r)
    want, group = components(rows)
    assert sorted((r[:3] for r in got), key=key) == sorted(want, key=key)
    assert all(k == (d == c) for d, _, c, k in got)
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    best = {}
    for (d, _), g in zip(rows, group):
        best[g] = min(best.get(g, (True, 0)), (d is None, d or 0))
    assert sorted((d is None, d or 0) for d, in collect(kept, "doc_id")) == sorted(best.values())
    assert near_dedup.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_one_doc_id_with_two_texts(spark, order):
    a, b = ([f"{c}{i}" for i in range(60)] for c in "ab")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (5, " ".join([*a, "tail"]))]
    d = spark.createDataFrame([rows[i] for i in order], "doc_id long, text string").coalesce(1)
    assert sorted(collect(near_dedup.near_duplicates(d), "doc_id", "component_id")) == [(1, 1), (1, 1), (5, 1)]
    none = spark.createDataFrame([(None, " ".join(a)), (None, " ".join([*a, "tail"])), (None, " ".join(b))], "doc_id long, text string")
    assert near_dedup.deduplicate(none).count() == 2


def test_crowded_region(spark):
    """One large group of near copies of one another, in more rows than a region compares in full."""
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[:60] + [f"v{i}"] + base[60:])) for i in range(150)] + [(1000 + i, " ".join(base[:60] + [f"u{i}_{k}" for k in range(90)])) for i in range(40)]
    got = collect(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "component_id")
    assert all(c == (0 if d < 1000 else d) for d, c in got)


# -- mixing ----------------------------------------------------------------------------------


def test_mixing(docs, nothing):
    rows = collect(docs, "doc_id", "text", "source")
    mass = collections.Counter()
    for _, t, s in rows:
        mass[s] += len(t or "") + 1
    total, w = sum(mass.values()), {s: m**mixing.TEMPERATURE for s, m in mass.items()}
    want = collections.Counter()
    for d, t, s in rows:
        rate = round(w[s] * total / (sum(w.values()) * mass[s]), 9)
        name = f"{mixing.SEED}:{'' if d is None else d}:{hashlib.md5((t or '').encode()).hexdigest()}"
        u = int(hashlib.md5(f"count:{name}".encode()).hexdigest()[:13], 16) / 2**52
        n, log, c = 0, -rate, math.exp(-rate)
        while c <= u:
            n += 1
            log += math.log(rate / n)
            c += math.exp(log)
        want[d, t, s] += n
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert collections.Counter(collect(out, "doc_id", "text", "source")) == +want
    assert mixing.mix(nothing).count() == 0
    only = mixing.mix(docs, weights={"s1": 1.0}, budget=0.5, extras=True)
    assert {s for s, in collect(only, "source")} == {"s1"}


def test_poisson_mean(spark):
    d = spark.range(4000).selectExpr("id as doc_id", "'abc' as text", "if(id % 4 = 0, 'a', 'b') as source")
    n = {r.source: r["count"] for r in mixing.mix(d, weights={"a": 0.5, "b": 0.5}).groupBy("source").count().collect()}
    assert abs(n["a"] - 2000) < 200 and abs(n["b"] - 2000) < 200
    assert mixing.mix(d.limit(3), weights={"a": 1.0, "b": 1.0}, budget=2000).count() > 4000


# -- fingerprints -----------------------------------------------------------------------------


def test_fingerprints(docs, nothing):
    rows = sorted(collect(docs.selectExpr("doc_id", "coalesce(text, '') as text", "xxhash64(coalesce(text, '')) as h"), "doc_id", "text", "h"), key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    want, alike = [], {}
    for i, (d, t, _) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        own, new = set(shingle_set(t).tolist()), set(shingle_set(fingerprints.edited(t, nxt)).tolist())
        want.append((d, len(t), hashlib.sha256(fingerprints.edited(t, nxt).encode()).hexdigest(), fingerprints.pack(fingerprints.bins(shingle_set(t)))))
        alike[d, want[-1][2]] = [(len(own & x) / len(own | x) if own | x else 1.0, len(own | x)) for x in (new, set(shingle_set(nxt).tolist()))]
    got = fingerprints.fingerprints(docs, n_buckets=5)
    for r in got.collect():  # the estimate is near the true likeness; few shingles fill many bins and leave it rough
        for x, (true, size) in zip((r.near_edited, r.near_next), alike[r.doc_id, r.edited_sha256]):
            assert abs(x - true) < (0.12 if size >= 300 else 0.5 if size >= 10 else 1.01)
    nulls = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert fingerprints.fingerprints(nulls, n_buckets=3).count() == len(rows)
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    assert sorted(collect(got, "doc_id", "n_chars", "edited_sha256", "fingerprint"), key=key) == sorted(want, key=key)
    assert fingerprints.fingerprints(nothing).count() == 0
    one = fingerprints.fingerprints(docs.where("doc_id = 3"), n_buckets=3).first()
    assert one.near_next == 1.0


@pytest.mark.parametrize(("same", "other"), [(400, 100), (300, 300), (20, 10), (1000, 0), (0, 500)])
def test_likeness(same, other):
    rng = np.random.default_rng(same)
    a, b, c = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (same, other, other))
    x, y = np.unique(np.concatenate((a, b))), np.unique(np.concatenate((a, c)))
    true = same / (same + 2 * other)
    got = fingerprints.likeness(fingerprints.bins(x), fingerprints.bins(y))
    assert abs(got - true) < 0.12
    assert (fingerprints.unpack(fingerprints.pack(fingerprints.bins(x))) == fingerprints.bins(x)).all()
    assert fingerprints.likeness(None, None) == 1.0 and fingerprints.likeness(None, fingerprints.bins(x)) == 0.0


# -- personal data ------------------------------------------------------------------------------

TEXTS = [
    "write to a.b@mail.example.com or x@y or @@c@d.e now",
    "at 10.0.0.1 and 999.1.1.1 and 1.2.3.4.5 and 0001.2.3.4 0000000000001.1.1.1",
    "card 4111 1111 1111 1111, bad 4111 1111 1111 1112, 5105-1051-0510-5100x",
    "call +1 (743) 555-3824 or +49 30 or (743) 555-3824 ext",
    'token = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B" and ssn 123-45-6789',
    "", "é" * 50 + " ß@ß.de q.r@s.t-u.v 12345678901234567890123",
]


def brute_base(t):
    out = [(m.start(), 0, m.end()) for m in pii.EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in pii.IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    for k, p, lo, hi in ((2, pii.CARD, 12, 19), (3, pii.PHONE, 9, 15)):
        for m in p.finditer(t):
            d = [int(c) for c in m.group() if c.isdigit()]
            luhn = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0
            if lo <= len(d) <= hi and (k == 3 or luhn):
                out.append((m.start(), k, m.end()))
    return [(pii.KINDS[k], a, b) for a, k, b in sorted(out)]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    assert pii.base_spans(text) == brute_base(text)


def test_base_spans_of_random_strings():
    rng = np.random.default_rng(9)
    for alphabet in ("ab1.@-_%é ", "0125. .", "45+ -1(", "a@.1"):
        for _ in range(4000):
            text = "".join(rng.choice(list(alphabet), rng.integers(1, 30)))
            assert pii.base_spans(text) == brute_base(text)


def test_very_long_runs():
    import time

    at = time.time()
    for unit in ("1", "a", "a@", "1.", "+1", "1-", "(", "token ", "a.", "@a."):
        pii.candidates(unit * (300_000 // len(unit)) + "@")
    assert time.time() - at < 60


def test_pii_odd_tables(spark, tmp_path):
    rows = spark.createDataFrame([(None, "a@b.cd", 1, "x"), (None, "a@b.cd", 1, "x"), (1, None, 2, "y"), (2, "", 3, "z")], "doc_id long, text string, found int, spans string")
    rows.write.parquet(str(tmp_path / "a" / "documents.parquet"))
    got = sorted((str(r.doc_id), r.n_email, r.spans) for r in pii.op5_pii(spark, str(tmp_path / "a")).collect())
    assert got == [("1", 0, ""), ("2", 0, ""), ("None", 1, "email:0:6"), ("None", 1, "email:0:6")]
    assert sorted(str(r.text) for r in pii.redact(rows).collect()) == ["", "None", "[email]", "[email]"] and pii.redact(rows).columns == rows.columns
    rows.limit(0).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert pii.op5_pii(spark, str(tmp_path / "b")).count() == 0 and pii.redact(rows.limit(0)).count() == 0


def test_pii_query(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS * 30)] + [(9999, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in pii.op5_pii(spark, str(tmp_path)).collect()}
    for d, t in rows:
        base = brute_base(t or "")
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        r = got[d]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, _, _ in base) for x in pii.KINDS)
        assert set(line.split(",")) <= {*r.spans.split(","), ""}
    assert "secret:" in got[4].spans and "phone:" in got[3].spans.split(",", 1)[1]
    red = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert red[0].startswith("write to [email]") and red[9999] is None and red[5] == "" and "4111 1111 1111 1112" in red[2]


# -- language --------------------------------------------------------------------------------------


def test_language(spark):
    say = {"de": "der und nicht ist die ungeheuer schön größer", "en": "the and not is that heather thing", "fr": "le et ne pas est élève garçon"}
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(rng.choice(say[k].split(), 12)), k) for i in range(400) for k in [list(say)[i % 3]]]
    d = spark.createDataFrame(rows + [(1000, None, "en"), (1001, "123 !", "en"), (1003, "½ ② ①", "en"), (1004, "der und nicht " * 40000, "fr"), (1002, "der und ist", None), (None, "the thing", "en")], "doc_id long, text string, lang string").selectExpr("*", "0 as score")
    m = language_id.fit(d.where(~language_id.held_out()))
    got = {r.doc_id: r for r in language_id.predict(d, m).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows)
    assert got[1000].lang_pred == got[1001].lang_pred == got[1003].lang_pred == "und" and got[1004].lang_pred == "de"
    assert got[1000].lang_pred == got[1001].lang_pred == "und" and got[1002].lang_pred == "de" and got[None].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got.values())
    none = language_id.fit(d.where("doc_id = 1000"))
    assert {r.lang_pred for r in language_id.predict(d, none).collect()} == {"und"}
    assert language_id.predict(d.limit(0), m).count() == 0


def test_kernel_ridge():
    """Scores equal those of ridge regression on exact kernels with all training texts as landmarks."""
    rng = np.random.default_rng(2)
    pools = ["der und nicht ist die schön größer".split(), "the and not is that heather thing".split(), "le et ne pas est élève garçon".split()]
    texts = [" ".join(rng.choice(pools[i % 3], 10)) for i in range(45)]
    labels = [("de", "en", "fr")[i % 3] for i in range(45)]

    def grams(t):
        t = " " + re.sub(r"[\W\d_]+", " ", t.lower()).strip() + " "
        return [{t[i : i + n] for i in range(len(t) - n + 1)} for n in (1, 2, 3, 4)]

    sets = [grams(t) for t in texts]
    k = np.array([[sum(len(a & b) / math.sqrt(len(a) * len(b)) for a, b in zip(x, y)) / 4 for y in sets] for x in sets])
    own = language_id.train([language_id.bits(t) for t in texts], labels, landmarks=45)
    land = [i for n in own.labels for i in range(45) if labels[i] == n]  # landmarks come by label
    assert np.abs(own.kernels([language_id.bits(t) for t in texts]) - k[:, land]).max() < 0.02  # n-grams may share a feature
    h = np.eye(45) - 1 / 45
    y = np.array([[1.0 if a == b else -1.0 for b in own.labels] for a in labels])
    alpha = np.linalg.solve(h @ k @ h + 45 * language_id.RIDGE * np.eye(45), h @ y)
    want = h @ k @ h @ alpha + y.mean(axis=0)
    assert np.abs(own.scores(texts) - want).max() < 0.05


def test_language_of_held_out_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r for r in language_id.op6_language_id(spark, "/root/testdata/sf0.01").join(d.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null and lang_pred != 'und'").collect()]
    assert len(got) > 100 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


# -- language model ------------------------------------------------------------------------------------


def dictionary_automaton(rows, held):
    """States, arcs and failure arcs as dictionaries, walked token by token."""
    count = [collections.Counter() for _ in range(4)]
    for d, t in rows:
        if not held(d):
            s = [None, *t]
            for n in (1, 2, 3):
                count[n].update(tuple(s[i : i + n]) for i in range(n == 1, len(s) - n + 1))
            count[1][None,] += 1
    starts = count[1].pop((None,), 0)
    total, v = sum(count[1].values()), len(count[1])
    size = lambda h: starts if h == (None,) else count[len(h)][h]
    p1 = lambda w: (count[1][w,] + 0.1) / (total + 0.1 * (v + 1))

    def arc(h, w, mu, less=0):  # the smoothed probability of w after h
        if not h:
            return p1(w)
        m = mu[len(h) - 1]
        return (max(0, count[len(h) + 1][*h, w] - less) + m * arc(h[1:], w, mu, less)) / (max(0, size(h) - less) + m)

    def walk(t, mu):
        h, out = (None,), 0.0
        for w in t:
            while h and not count[len(h) + 1][*h, w]:
                m = mu[len(h) - 1]
                out += math.log10(m / (size(h) + m))
                h = h[1:]
            out += math.log10(arc(h, w, mu))
            h = (*h, w)[-2:]
            while h and not size(h):
                h = h[1:]
        return out

    def strength(n):  # the best prior of n-grams given the counts of contexts of n - 1 words, on a grid of means by binary digits
        once, bins = sum(c == 1 for c in count[n].values()), collections.defaultdict(list)
        for c in count[n - 1].values():
            bins[c.bit_length()].append(c)
        like = lambda m: once * math.log(m) - sum(sum(x) * math.log(sum(x) / len(x) - 1 + m) for x in bins.values())
        lo, hi = -7.0, 21.0
        for _ in range(200):
            a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
            lo, hi = (a, hi) if like(math.exp(a)) < like(math.exp(b)) else (lo, b)
        return math.exp(lo)

    mu = (strength(2), strength(3))
    return count[1], total, p1, lambda t: walk(t, mu)


def test_lm(docs, nothing, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SEGMENT", 100)
    rows = [(d, [*words(t or ""), b"\0end"]) for d, t in collect(docs, "doc_id", "text")]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    uni, n, p, walk = dictionary_automaton(rows, held)
    want = [(d, held(d), len(t), sum(uni[w,] > 0 for w in t), n, round(sum(math.log10(p(w)) for w in t), 6), round(walk(t), 6)) for d, t in rows]
    got = lm_scoring.score(docs.drop("score", "grp").selectExpr("*", "7 as score"), plain=True)
    got = [(*r[:5], round(r[5], 6), round(r[6], 6)) for r in collect(got, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-5, abs=1e-4)
    assert lm_scoring.score(nothing).count() == 0


def test_lm_groups_do_not_matter(docs, monkeypatch):
    one = sorted(collect(lm_scoring.score(docs), "doc_id", "n_tokens", F.round("score", 6)), key=str)
    monkeypatch.setattr(lm_scoring, "GROUP_BYTES", 5000)
    monkeypatch.setattr(lm_scoring, "SHARD_BYTES", 20000)
    assert sorted(collect(lm_scoring.score(docs.repartition(3)), "doc_id", "n_tokens", F.round("score", 6)), key=str) == one


# -- passages -----------------------------------------------------------------------------------------


def covered(docs, least):
    """Words of each document in a run of ``least`` that another document has, by brute force."""
    rows = list({(d, t or "") for d, t in collect(docs, "doc_id", "text")})
    has = collections.defaultdict(set)
    for k, (_, t) in enumerate(rows):
        w = words(t)
        for i in range(len(w) - least + 1):
            has[tuple(w[i : i + least])].add(k)
    out = {}
    for d, t in rows:
        w = words(t)
        mark = np.zeros(len(w), bool)
        for i in range(len(w) - least + 1):
            if len(has[tuple(w[i : i + least])]) > 1:
                mark[i : i + least] = True
        out[d, t] = mark
    return out


def marks(docs, found):
    by = collections.defaultdict(list)
    for d, a, b in found:
        by[d].append((a, b))
    out = {}
    for d, t in {(d, t or "") for d, t in collect(docs, "doc_id", "text")}:
        spots = [m.span() for m in re.finditer(r"[^ \t-\r]+", t)]
        out[d, t] = np.array([any(a <= s and e <= b for a, b in by[d]) for s, e in spots], bool)
    return out


def test_repeated_passages(docs, nothing):
    got = marks(docs, collect(suffix_dedup.repeated_passages(docs), "doc_id", "start", "end"))
    want, sure = covered(docs, suffix_dedup.LEAST), covered(docs.where("doc_id < 60 or doc_id > 71 or doc_id is null"), suffix_dedup.LEAST)
    assert not any((got[k] & ~want[k]).any() for k in want)
    assert all(got[k][sure[k]].all() for k in sure)
    # among near copies a neighbour may differ just outside the common start
    assert sum(got[k].sum() for k in want) >= 0.97 * sum(want[k].sum() for k in want)
    assert suffix_dedup.repeated_passages(nothing).count() == 0


def test_near_passages(docs, nothing, spark):
    got = marks(docs, collect(window_dedup.near_passages(docs), "doc_id", "start", "end"))
    want = covered(docs, 70)  # exact passages are near ones too
    for k in want:
        assert (got[k] | ~want[k]).mean() >= 0.999 if len(want[k]) else True
    assert window_dedup.near_passages(nothing).count() == 0
    rng = np.random.default_rng(4)
    text = lambda n: [f"q{x}" for x in rng.integers(0, 10**6, n)]
    p = text(90)
    near = list(p)
    near[20] = "changed"
    del near[45]
    rows = [(1, " ".join(text(200) + p + text(150))), (2, " ".join(text(40) + near + text(300))), (3, " ".join(text(400)))]
    found = collect(window_dedup.near_passages(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_words", "other_doc_id")
    assert {(d, o) for d, _, o in found} == {(1, 2), (2, 1)} and all(80 <= n <= 100 for _, n, _ in found)
