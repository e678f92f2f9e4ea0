"""Fingerprints, SimHash groups, quality rules, toxicity and site posteriors."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from conftest import SF001, SF01
from pyspark.sql import functions as F

from featuremill.llm import features, order_minhash, quality_rules, queries, simhash, site_quality, toxicity
from featuremill.llm.common import read
from featuremill.llm.components import connected_components

from odd_rows import none_at_all, odd  # noqa: F401  (fixtures)


def documents(spark, sf_dir=SF001):
    return {r.doc_id: r.text or "" for r in read(spark, sf_dir, "documents").collect()}


# -- Order MinHash ---------------------------------------------------------------------------

def plain_signature(own, text):
    """The same selection k-mer by k-mer, without rolling hashes of the whole text."""
    if not text:
        return [0] * own.hashes
    k, seen, kmers, numbered = own.k, {}, [], []
    for i in range(max(1, len(text) - k + 1)):
        h = order_minhash.kmer_hashes(text[i:i + k], k)
        kmers.append(h[0])
        seen[h[0]] = seen.get(h[0], -1) + 1
        with np.errstate(over="ignore"):
            numbered.append(order_minhash.mix(h + np.uint64(seen[h[0]]) * order_minhash.C)[0] >> order_minhash.S2)
    out = []
    with np.errstate(over="ignore"):
        for seed in own.seeds:
            x = np.array(numbered, np.uint32) ^ np.uint32(seed >> order_minhash.S2)
            x = x * order_minhash.A32
            x ^= x >> order_minhash.S15
            x *= order_minhash.B32
            x ^= x >> order_minhash.S15
            least = sorted(sorted(range(len(x)), key=lambda i: (x[i], i))[:own.tuple_size])
            entry = np.array([seed])
            for i in least:
                entry = order_minhash.mix(entry * order_minhash.BASE + kmers[i])
            out.append(int((entry[0] >> order_minhash.S2) | np.uint64(1)) & 0xFFFFFFFF)
    return out


def test_signature_against_plain():
    own = order_minhash.OrderMinHash(k=5, hashes=8, tuple_size=3)
    rnd = random.Random(3)
    for _ in range(60):
        text = "".join(rnd.choice("abé🙂 ") for _ in range(rnd.randint(0, 80)))
        assert own.signature(text).tolist() == plain_signature(own, text), text


def test_signature_follows_order():
    own = order_minhash.OrderMinHash(k=3, hashes=64, tuple_size=2)
    rnd = random.Random(1)
    text = "".join(rnd.choice("abcdefghijklmnop") for _ in range(400))
    close = text[:200] + "#" + text[200:]
    swapped = text[200:] + text[:200]
    a, b, c = (order_minhash.likeness(own.signature(text), own.signature(t)) for t in (text, close, swapped))
    assert a == 1 and b > 0.8 and c < b - 0.2


def test_neighbour_query(spark):
    docs = documents(spark)
    ids = sorted(docs)
    own = order_minhash.OrderMinHash()
    got = {r.doc_id: r for r in queries.op1_order_minhash(spark, SF001).collect()}
    assert sorted(got) == ids
    for i, nxt in zip(ids, ids[1:] + ids[:1]):
        text, n = docs[i], len(docs[i]) // 4
        changed = text[:len(text) - n] + docs[nxt][:n]
        r, a = got[i], own.signature(text)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == order_minhash.as_text(a)
        assert r.edited_fingerprint == order_minhash.as_text(own.signature(changed))
        assert r.near_edited == order_minhash.likeness(a, own.signature(changed))
        assert r.near_next == order_minhash.likeness(a, own.signature(docs[nxt]))


def test_neighbour_odd_rows(odd, none_at_all):
    got = order_minhash.neighbour_likeness(odd, partitions=5).collect()
    assert len(got) == odd.count()
    assert {r.fingerprint for r in got if r.n_chars == 0} == {"0" * 256}
    assert len({r.fingerprint for r in got if r.doc_id in (5, 6)}) == 1
    assert order_minhash.neighbour_likeness(none_at_all).count() == 0
    assert order_minhash.fingerprint_documents(odd).count() == odd.count()
    (one,) = order_minhash.neighbour_likeness(odd.where("doc_id = 8")).collect()
    assert one.near_next == 1


# -- SimHash ---------------------------------------------------------------------------------

def groups_by_force(fps, distance=3):
    """Smallest index reachable, by comparing all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def slow_fingerprint(text, words=3):
    from xxhash import xxh64_intdigest
    import re
    own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not own:
        return 0
    grams = [" ".join(own[i:i + words]) for i in range(max(1, len(own) - words + 1))]
    h = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_query(spark):
    docs = documents(spark, SF01)
    ids = sorted(docs)
    fps = [slow_fingerprint(docs[i]) for i in ids]
    roots = groups_by_force(fps)
    got = {r.doc_id: r for r in queries.op9_simhash(spark, SF01).collect()}
    assert sorted(got) == ids
    for n, i in enumerate(ids):
        assert got[i].fingerprint == f"{fps[n]:016x}"
        assert got[i].component_id == ids[roots[n]]


@pytest.mark.parametrize("large", [3, 4096])
def test_links_of_large_keys(spark, large):
    """Clusters of fingerprints a few bits apart, compared directly and keyed once more."""
    rnd = random.Random(5)
    fps = set()
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(40):
            fps.add(x)
            for b in rnd.sample(range(64), rnd.choice([1, 2, 3, 4])):
                x ^= 1 << b
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {r.node: r.root for r in connected_components(simhash.verified_links(nodes, large=large)).collect()}
    want = groups_by_force([f & (1 << 64) - 1 for f in fps])
    for f, w in zip(fps, want):
        assert roots.get(f, f) == fps[w]


def test_components_of_a_path(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    more = spark.createDataFrame([(1000, 1001), (1001, 1000), (1005, 1005)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges.union(more)).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_simhash_odd_rows(odd, none_at_all):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    assert {r.component_id for r in got if r.fp == 0} == {1}
    assert {r.component_id for r in got if r.doc_id in (5, 6)} == {5}
    assert simhash.near_duplicates(none_at_all).count() == 0
    kept = simhash.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or -1, (r.text or "")[:9]) for r in kept.collect()) == [
        (-1, "alpha bet"), (1, ""), (2, "other tex"), (3, "long word"), (5, "the same "), (7, "password="),
        (8, "x" * 9)]
    assert simhash.keep_one_of_each(none_at_all).count() == 0


def test_components_of_equal_and_null_ids(spark):
    """An id on rows of two components keeps a row of each; a component of null ids keeps one."""
    rnd = random.Random(9)
    a, b, c = ([f"w{rnd.randrange(10 ** 6)}" for _ in range(400)] for _ in range(3))

    def near(words):
        """A text 1 to 3 bits away."""
        fp = slow_fingerprint(" ".join(words))
        return next(t for t in (" ".join([*words, f"end{i}"]) for i in range(1000))
                    if 0 < (slow_fingerprint(t) ^ fp).bit_count() <= 3)

    a_near, b_near, c_near = map(near, (a, b, c))
    a, b, c = (" ".join(w) for w in (a, b, c))
    assert len(set(groups_by_force([slow_fingerprint(t) for t in (a, a_near, b, b_near, c, c_near)]))) == 3
    df = spark.createDataFrame([(7, a), (7, b), (9, b_near), (9, a_near), (None, c), (None, c_near)],
                               "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in simhash.keep_one_of_each(df).collect()]
    assert len(kept) == 3 and {(7, a), (7, b)} < set(kept)
    assert len({(None, c), (None, c_near)} & set(kept)) == 1


# -- quality rules ---------------------------------------------------------------------------

def slow_coverage(words, n):
    grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
    inside = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(n)}
    return inside


def test_repetition_against_plain():
    rnd = random.Random(2)
    for _ in range(150):
        words = [rnd.choice("abcde") * rnd.randint(1, 3) for _ in range(rnd.randint(0, 60))]
        text = "".join(w + rnd.choice([" ", "\n", "\t "]) for w in words)
        got = quality_rules.measure(text)
        total = sum(map(len, words))
        assert got["n_words"] == len(words) and got["word_chars"] == total
        assert got["n_repeat_words"] == len(slow_coverage(words, 5))
        for n in quality_rules.LIMITS:
            want = sum(len(words[i]) for i in slow_coverage(words, n)) / total if total else 0
            assert abs(got[f"coverage_{n}"] - want) < 1e-12


def test_hash_collisions_do_not_count():
    ids = np.arange(12, dtype=np.uint64)
    assert len(quality_rules.repeated_starts(ids, 2, np.zeros(11, np.uint64))) == 0


def test_quality_odd_rows(odd, none_at_all):
    got = quality_rules.repetition_coverage(odd)
    assert got.count() == odd.count() and got.where("n_words = 0 AND kept").count() == 0
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns and kept.count() == got.where("kept").count()
    assert quality_rules.repetition_coverage(none_at_all).count() == quality_rules.keep_good(none_at_all).count() == 0


def test_one_word_that_covers_much():
    text = " ".join(["###", *(f"word{i}" for i in range(12))] * 1)
    assert quality_rules.measure(text)["word_coverage"] == 0.0  # found once
    words = [w for i in range(40) for w in (f"w{i}x{i * i}", "###")]
    got = quality_rules.measure(" ".join(words))
    assert got["word_coverage"] == 120 / sum(map(len, words)) and not got["base_failed"] and not got["kept"]


def test_the_coverage_decides(spark):
    """Some documents that pass the base rule are rejected by the coverage alone."""
    got = quality_rules.repetition_coverage(read(spark, SF01, "documents"))
    assert got.where("NOT kept AND NOT base_failed").count() > 0


def test_clean_documents_stay(spark):
    docs, labels = read(spark, SF01, "documents"), read(spark, SF01, "labels")
    got = quality_rules.repetition_coverage(docs).join(labels, "doc_id").where("quality = 1 AND NOT base_failed")
    assert got.where("NOT kept").count() <= 0.01 * got.count()


# -- toxicity --------------------------------------------------------------------------------

def planted(n, seed, toxic_share=0.15):
    rnd = random.Random(seed)
    common = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6))) for _ in range(400)]
    docs = []
    for _ in range(n):
        words = [rnd.choice(common) for _ in range(rnd.randint(20, 120))]
        toxic = rnd.random() < toxic_share
        if toxic:
            for _ in range(rnd.randint(1, 4)):
                words[rnd.randrange(len(words))] = rnd.choice(["vilex", "grubol", "snark" + rnd.choice(common)])
        docs.append((" ".join(words), int(toxic)))
    return docs


def test_toxicity_learns_from_positives_and_unlabelled(spark):
    docs = planted(3000, 4)
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(docs)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(docs) if i % 2], "doc_id long, toxic int")
    scorer = toxicity.train(df, labels)
    got = {r.doc_id: r for r in toxicity.score_documents(df, scorer).collect()}
    out = [i for i in range(len(docs)) if zlib.crc32(str(i).encode()) % 4 == 2]
    hit = [got[i].predicted == docs[i][1] for i in out]
    assert sum(hit) >= 0.97 * len(hit)
    # labels of held-out rows change nothing
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.train(df, flipped)
    assert (again.weight, again.bias) == (scorer.weight, scorer.bias)


def test_training_sample_is_bounded_in_rows(spark):
    """Tied ids are rows of their own, repeated rows are one, null ids have no label."""
    rows = [(5, f"text {i} of one id") for i in range(4000)] + [(7, "the same")] * 3000 + [(None, f"none {i}") for i in range(2000)]
    rows += [(100 + i, f"other {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ids = [i for i in [5, 7, *range(100, 400)] if zlib.crc32(str(i).encode()) % 4 != 2]
    labels = spark.createDataFrame([(i, int(i < 110)) for i in ids], "doc_id long, toxic int")
    got, prior = toxicity.training_rows(df, labels, positives=10, unlabelled=20)
    again, _ = toxicity.training_rows(df.repartition(7), labels, positives=10, unlabelled=20)
    assert [(r[0].tolist(), r[1:]) for r in got] == [(r[0].tolist(), r[1:]) for r in again]
    assert 0 < sum(r[2] for r in got) <= 20 and 0 < sum(r[3] for r in got) <= 40
    toxic = sum(1 for i, t in set(rows) if i is not None and i in ids and i < 110)
    both = sum(1 for i, t in set(rows) if i is not None and i in ids)
    assert abs(prior - min(0.9, toxic / both)) < 1e-12
    model = site_quality.train(df, labels.withColumnRenamed("toxic", "quality"), sample=30)
    assert np.isfinite(model.weights).all()


def test_risk_and_gradient_against_plain():
    """The risk, term by term, and its slope by small steps, on both sides of zero."""
    rnd = np.random.default_rng(3)
    vocabulary = np.arange(10, dtype=np.uint32)
    texts = [np.flatnonzero(rnd.random(10) < 0.4).astype(np.uint32) for _ in range(40)]
    positive, mixed = texts[:12], texts[8:]
    p, u = features.SparseRows(positive, vocabulary), features.SparseRows(mixed, vocabulary)

    def plain(x, prior):
        score = lambda t: sum(x[int(h)] for h in t) + x[-1]
        loss = lambda f: np.log1p(np.exp(-f))
        of_p = sum(loss(score(t)) for t in positive) / len(positive)
        of_u = sum(loss(-score(t)) for t in mixed) / len(mixed)
        return prior * of_p, of_u - prior * sum(loss(-score(t)) for t in positive) / len(positive)

    signs = set()
    for trial in range(40):
        x, prior = rnd.normal(0, 2, 11), [0.2, 0.9][trial % 2]
        risk = plain(x, prior)
        assert np.allclose(toxicity.pu_risk(x, p, u, prior), risk)
        signs.add(risk[1] < 0)
        want = []
        for k in range(11):
            step = np.eye(11)[k] * 1e-6
            up, down = plain(x + step, prior), plain(x - step, prior)
            want.append((-(up[1] - down[1]) if risk[1] < 0 else sum(up) - sum(down)) / 2e-6)
        assert np.allclose(toxicity.pu_gradient(x, p, u, prior), want, atol=1e-6)
    assert signs == {True, False}


def test_feature_selection_against_plain(spark):
    """Counts over all rows, and the z value of each feature of two or more toxic texts."""
    docs = planted(400, 9)
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(docs)], "doc_id long, text string").repartition(6)
    positive = [features.text_features(t) for t, y in docs if y]
    hashes, toxic = toxicity.candidate_features(positive)
    in_all, n_all = toxicity.corpus_counts(df, hashes)
    sets = [set(features.text_features(t).tolist()) for t, _ in docs]
    n = len(positive)
    want = {h for h in set().union(*(set(x.tolist()) for x in positive)) if sum(h in x for x in positive) > 1}
    assert set(hashes.tolist()) == want and n_all == len(docs)
    clear = set()
    for h, a, b in zip(hashes.tolist(), toxic, in_all):
        assert a == sum(h in x for x in positive) and b == sum(h in x for x in sets)
        pooled = (a + b) / (n + n_all)
        if a / n - b / n_all >= 3 * (max(pooled * (1 - pooled), 1e-12) * (1 / n + 1 / n_all)) ** 0.5:
            clear.add(h)
    assert set(toxicity.select_features(hashes, toxic, n, in_all, n_all).tolist()) == clear
    mixed = [features.text_features(t) for t, _ in docs[::2]]
    few, _ = toxicity.candidate_features(positive, mixed)
    assert set(few.tolist()) == {h for h in want if sum(h in set(x.tolist()) for x in positive) / n
                                 > sum(h in set(x.tolist()) for x in mixed) / len(mixed)}


def test_scorer_sees_the_features_of_training():
    """The scorer's sum equals the weights of ``text_features``, shared beginnings included."""
    rnd = random.Random(6)
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 8))) for _ in range(60)]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(0, 40))) for _ in range(40)]
    known = np.unique(np.concatenate([features.text_features(t) for t in texts]))[::2]
    weight = {int(h): rnd.random() for h in known}
    scorer = features.LinearScorer(known, np.array([weight[int(h)] for h in known]), -1.0)
    for text in texts + texts:  # the second time from the memo table
        want = -1.0 + sum(weight.get(int(h), 0.0) for h in features.text_features(text))
        assert abs(scorer.margin(text) - want) < 1e-9
    shared = features.again(zlib.crc32(b"abca-"))
    assert shared in features.text_features("abcabb ABCACC") and shared not in features.text_features("abcabb abcabb")


def test_toxicity_odd_rows(spark, odd, none_at_all):
    labels = spark.createDataFrame([(5, 1), (5, 0), (None, 1), (8, 0), (3, None)], "doc_id long, toxic int")
    scorer = toxicity.train(odd, labels)
    got = toxicity.score_documents(odd, scorer).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    kept = toxicity.keep_clean(odd, scorer)
    assert kept.columns == odd.columns and kept.count() == sum(1 - r.predicted for r in got)
    nothing = toxicity.train(odd, labels.limit(0))
    assert {r.predicted for r in toxicity.score_documents(odd, nothing).collect()} == {0}
    assert toxicity.score_documents(none_at_all, scorer).count() == toxicity.keep_clean(none_at_all, scorer).count() == 0


# -- site quality ----------------------------------------------------------------------------

def test_posteriors_against_plain(spark):
    rnd = random.Random(8)
    rows = [(i, f"h{min(i % 7, 3)}", f"p{i % 3}", min(0.99, max(0.01, rnd.random()))) for i in range(400)]
    rows.append((400, "lone", "", 0.9))
    got = {r.doc_id: r for r in site_quality.site_posteriors(
        spark.createDataFrame(rows, "doc_id long, host string, path string, p double")).collect()}
    assert len(got) == len(rows)
    mean = sum(r[3] for r in rows) / len(rows)
    host = {h: [r[3] for r in rows if r[1] == h] for h in {r[1] for r in rows}}
    path = {k: [r[3] for r in rows if r[1:3] == k] for k in {r[1:3] for r in rows}}
    spread = np.mean([(np.mean(v) - mean) ** 2 for v in host.values() if len(v) > 1])
    k_host = site_quality._strength(spread, mean)
    spread = np.mean([(np.mean(v) - np.mean(host[k[0]])) ** 2 for k, v in path.items() if len(v) > 1])
    k_path = site_quality._strength(spread, mean)
    for i, h, q, p in rows:
        a = (k_host * mean + sum(host[h]) - p) / (k_host + len(host[h]) - 1)
        b = (k_path * a + sum(path[h, q]) - p) / (k_path + len(path[h, q]) - 1)
        odds = np.log(p / (1 - p)) + np.log(b / (1 - b)) - np.log(mean / (1 - mean))
        assert abs(got[i].host_posterior - a) < 1e-9 and abs(got[i].path_posterior - b) < 1e-9
        assert abs(got[i].posterior - 1 / (1 + np.exp(-odds))) < 1e-9
    assert abs(got[400].host_posterior - mean) < 1e-9  # one document does not vouch for itself


def test_site_quality_on_documents(spark):
    labels = {r.doc_id: r.quality for r in read(spark, SF01, "labels").collect()}
    got = queries.op4_site_quality(spark, SF01).collect()
    assert len(got) == read(spark, SF01, "documents").count()
    good = [r.kept for r in got if labels.get(r.doc_id) == 1]
    bad = [r.kept for r in got if labels.get(r.doc_id) == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_site_odd_rows(spark, odd, none_at_all):
    labels = spark.createDataFrame([(5, 1), (8, 0), (None, 1)], "doc_id long, quality int")
    got = site_quality.classify(odd, labels, F.col("source"), F.col("lang"))
    assert got.count() == odd.count() and {r.host for r in got.collect()} == {""}
    assert site_quality.classify(none_at_all, labels, F.col("source"), F.col("lang")).count() == 0
    url = spark.createDataFrame([("https://a.b.org:80/x/y?z=1",), ("http://q.net",)], "u string")
    assert [tuple(r) for r in url.select(site_quality.url_host(F.col("u")), site_quality.url_path(F.col("u"))).collect()] \
        == [("a.b.org", "x"), ("q.net", "")]
