"""Exact, near and suffix dedup against plain versions."""

import hashlib
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tideglass.llm import exact_dedup as E
from tideglass.llm import near_copies as N
from tideglass.llm import simhash as H
from tideglass.llm import suffix_dedup as U
from tideglass.llm.common import without
from tideglass.llm.components import components


def low(t):
    return (t or "").encode("utf-8", "surrogatepass").lower()


@pytest.mark.parametrize("capacity", [2, 1 << 14])
def test_exact(documents, capacity):
    texts = [(r.doc_id, low(r.text)) for r in documents.select("doc_id", "text").collect()]
    groups = {}
    for i, b in texts:
        groups.setdefault(b, []).append(i)
    found = {r.doc_id: r for r in E.exact_dedup(documents, capacity=capacity).collect()}
    assert len(found) == len(texts)
    for i, b in texts:
        r, g = found[i], groups[b]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (max(g), len(g), i == max(g), hashlib.sha256(b).hexdigest())


def test_exact_hard(hard, empty):
    rows = E.exact_dedup(hard, capacity=2).collect()
    assert len(rows) == hard.count()
    by = {(r.doc_id, r.text_sha256): r for r in rows}
    sha = lambda t: hashlib.sha256(low(t)).hexdigest()
    assert by[1, sha("")].keep_id == 2 and by[2, sha("")].kept and by[2, sha("")].group_size == 3  # with the null id's empty text
    assert [by[k, sha("two words")].kept for k in (5, 6, 7)] == [False, False, True]
    assert by[14, sha("twice")].group_size == 2 and by[14, sha("twice")].kept and by[14, sha("another text of one id")].kept
    assert E.exact_dedup(empty).count() == 0
    kept = E.drop_copies(hard)
    assert kept.columns == hard.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [2, 3, 4, 7, 8, 9, 10, 11, 12, None, None, 14, 14, 14]))


@pytest.mark.parametrize("digest", [None, lambda norm: F.lit("one")])
def test_exact_collisions(hard, digest):
    """Keys of two values, and a digest that all texts share: only equal bytes make groups."""
    more = {"digest": digest} if digest else {}
    wanted = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in E.exact_dedup(hard).collect())
    found = E.exact_dedup(hard, capacity=1, key=lambda norm: F.shiftleft(F.length(norm).cast("long") % 2, 62), **more)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in found.collect()) == wanted


def test_whole_rows_are_not_shuffled(spark, tmp_path):
    """Rows outside the filter take part in no shuffle: the join with what is dropped stays above the filter's."""
    spark.range(5000).selectExpr("id AS doc_id", "repeat(cast(id as string), 50) AS text").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    kept = without(docs, spark.range(0, 5000, 50).select("id"), [F.col("doc_id")])
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [k for k in range(5000) if k % 50]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "LeftOuter" in plan


def test_directory(spark):
    keys = spark.range(2000).selectExpr("xxhash64(id) AS key")
    cells = E.directory(keys, 50).collect()
    depth = cells[0].directory_depth
    assert sorted(c.cell for c in cells) == list(range(1 << depth))
    lead = np.array([r.key for r in keys.collect()], np.int64).view(np.uint64) >> np.uint64(64 - depth)
    bucket = {c.cell: c.bucket for c in cells}
    assert max(np.unique([bucket[int(x)] for x in lead], return_counts=True)[1]) <= 50


def plain_fingerprint(text, width=3):
    words = low(text).split()
    shingles = [b" ".join(words[k : k + width]) for k in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def plain_components(values):
    parent = {i: i for i, _ in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in combinations(values, 2):
        if (a ^ b).bit_count() <= 2:
            x, y = sorted((root(i), root(j)))
            parent[y] = x
    return {i: root(i) for i, _ in values}


@pytest.mark.parametrize("bucket", [1, 16])
def test_simhash(documents, bucket):
    values = [(r.doc_id, plain_fingerprint(r.text)) for r in documents.collect()]
    wanted = plain_components(values)
    found = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in H.simhash_dedup(documents, bucket=bucket).collect()}
    assert found == {i: (f, wanted[i]) for i, f in values}


def test_links_of_a_dense_family(spark):
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 1 << 63))
    family = {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (150, 2))} | {int(x) for x in rng.integers(0, 1 << 63, 50)}
    values = sorted(family)
    df = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    wanted = plain_components([(v, v) for v in values])
    for bucket in (1, 8):
        links = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in H.near_links(df, bucket).collect()]
        assert all((a ^ b).bit_count() <= 2 for a, b in links)
        parent = {v: v for v in values}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
        assert {v: root(v) for v in values} == wanted


def test_null_ids_link_others(spark, monkeypatch):
    values = {"a": 0b0011, "mid": 0, "b": 0b1100, "far": 0xFF00FF00}
    monkeypatch.setattr(H, "fingerprints", lambda docs, *_: docs.selectExpr("doc_id", "fp"))
    rows = [(2, values["a"]), (None, values["mid"]), (1, values["b"]), (None, values["far"])]
    found = H.simhash_dedup(spark.createDataFrame(rows, "doc_id long, fp long")).collect()
    assert {(r.doc_id, int(r.fingerprint, 16)): r.component_id for r in found} == {(2, 3): 1, (None, 0): 1, (1, 12): 1, (None, 0xFF00FF00): None}


def test_simhash_hard(hard, empty):
    rows = H.simhash_dedup(hard).collect()
    assert len(rows) == hard.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert {r.component_id for k in (1, 2, 3) for r in by[k]} == {1} and by[1][0].fingerprint == "0" * 16
    assert {r.component_id for k in (5, 6, 7) for r in by[k]} == {5}
    assert H.simhash_dedup(empty).count() == 0


def plain_near(texts):
    """Least id of each group of texts whose sets of five-word shingles have a Jaccard coefficient of 0.8 or more."""
    sets = {}
    for i, t in texts:
        w = low(t).split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(x & y) >= 0.8 * len(x | y):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in sets}


def test_near_copies(spark):
    rng = __import__("random").Random(6)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    rows = []
    for _ in range(150):
        text = rng.choices(words, k=rng.choice([3, 30, 90, 400]))
        for edits in (0, 0, 1, 2, 4, 9)[: rng.randint(1, 6)]:
            own = text[:]
            for at in rng.sample(range(len(own)), min(edits, len(own) // 20)):
                own[at] = rng.choice(words)
            rows.append((len(rows), " ".join(own)))
    passage = " ".join(rng.choices(words, k=60))  # in many texts that have little else in common
    rows += [(len(rows) + k, passage + " " + " ".join(rng.choices(words, k=60))) for k in range(80)]
    wanted = plain_near(rows)
    found = {r.doc_id: r.component_id for r in N.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    linked = [i for i in wanted if wanted[i] != i]
    assert sum(found[i] == wanted[i] for i in linked) >= 0.99 * len(linked) and not [i for i in wanted if wanted[i] == i and found[i] != i]


def test_near_copies_of_a_family(spark):
    """Far more copies than an entry's nodes meet each other: all belong to the text that they come from."""
    rng = __import__("random").Random(9)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    text, rows = rng.choices(words, k=200), []
    for k in range(400):
        own = text[:]
        for at in rng.sample(range(200), 3 if k else 0):
            own[at] = rng.choice(words)
        rows.append((k, " ".join(own)))
    assert {r.component_id for r in N.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {0}

def test_near_copies_away_from_the_hub(spark):
    """Texts near a member of a crowded family, but not near those that stand in most entries, are still linked."""
    pick = __import__("random").Random(3)
    base = [f"w{pick.randrange(10**6)}" for _ in range(300)]

    def edited(words, count):
        own = [*words]
        for k in pick.sample(range(len(own)), count):
            own[k] = f"e{pick.randrange(10**6)}"
        return own

    near = [edited(base, 3) for _ in range(60)]
    rows = [(k, " ".join(w)) for k, w in enumerate([base, *near, *(edited(w, 5) for w in near)])]
    found = {r.doc_id: r.component_id for r in N.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == plain_near(rows)


def test_near_copies_leave_no_proposed_pair_undecided(spark):
    """Each text is an edit of any earlier one: most are far from all hubs, and near few of the many that share their entries."""
    pick, n = __import__("random").Random(4), 500
    texts = [[f"w{pick.randrange(10**6)}" for _ in range(100)]]
    while len(texts) < n:
        own = [*texts[pick.randrange(len(texts))]]
        for k in pick.sample(range(100), 2):
            own[k] = f"e{pick.randrange(10**6)}"
        texts.append(own)
    rows = [(k, " ".join(w)) for k, w in enumerate(texts)]
    shingles, segments = [{*N.shingles(t).tolist()} for _, t in rows], [{*N.segments(t)} for _, t in rows]
    near = lambda i, j: len(shingles[i] & shingles[j]) >= N.SIMILARITY * len(shingles[i] | shingles[j])
    pairs = [(i, j) for i in range(n) for j in range(i) if len(segments[i] & segments[j]) >= 2 and near(i, j)]
    found = {r.doc_id: r.component_id for r in N.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), bucket=2).collect()}
    assert not [p for p in pairs if found[p[0]] != found[p[1]]]


def test_near_copies_sketches_bound_the_coefficient():
    """Sketches never differ in more buckets than the texts have shingles apart."""
    pick = __import__("random").Random(8)
    for n, edits in ((0, 0), (3, 1), (60, 1), (60, 9), (400, 5), (400, 60), (5000, 700)):
        one = [f"w{pick.randrange(500)}" for _ in range(n)]
        other = [*one]
        for k in pick.sample(range(n), edits):
            other[k] = f"e{pick.randrange(500)}"
        x, y = (N.shingles(" ".join(w)) for w in (one, other))
        differ = int(np.bitwise_count((N.sketch(x) ^ N.sketch(y)).view(np.uint64)).sum())  # of signed words it counts their absolute value
        assert differ <= len(np.setxor1d(x, y)) and (differ > 0) == (edits > 0)


def test_near_copies_far_texts_of_a_family_make_no_rows(spark, monkeypatch):
    """Many texts that share entries and are no near copies are decided without a row for each two; near ones among them are linked."""
    pick, verified, counts = __import__("random").Random(5), N._verified, []

    def edited(words, count):
        own = [*words]
        for k in pick.sample(range(len(own)), count):
            own[k] = f"e{pick.randrange(10**6)}"
        return own

    base = [f"w{pick.randrange(10**6)}" for _ in range(200)]
    far = [edited(base, 7) for _ in range(150)]
    rows = [(k, " ".join(w)) for k, w in enumerate([*far, *(edited(w, 1) for w in far[:20])])]

    def counted(rows, entries, found, words, similarity):
        counts.append(found.count())
        return verified(rows, entries, found, words, similarity)

    monkeypatch.setattr(N, "_verified", counted)
    found = {r.doc_id: r.component_id for r in N.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), bucket=4).collect()}
    assert found == plain_near(rows) and len({*found.values()}) == 150
    assert counts[1] <= 100, counts


def test_near_copies_hard(hard, empty):
    found = N.near_copies(hard)
    assert found.count() == hard.count() and N.near_copies(empty).count() == 0
    kept = N.drop_near(hard)
    assert kept.columns == hard.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 2 and ids.count(14) == 3 and 1 in ids and not {2, 3, 6, 7} & {*ids}


def test_components(spark):
    chain = [(k, k + 1) for k in range(200)] + [(1000, 1001), (1001, 1002), (1002, 1000), (2000, 2000)]
    found = {r.node: r.label for r in components(spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert found == {**{k: 0 for k in range(201)}, 1000: 1000, 1001: 1000, 1002: 1000}


def plain_repeats(rows, size):
    seen, out = set(), {}
    for i, raw in rows:
        gone = bytearray(len(raw))
        for k in range(len(raw) - size + 1):
            s = raw[k : k + size]
            if s in seen:
                gone[k : k + size] = b"\1" * size
            seen.add(s)
        out[i] = (sum(gone), sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest())
    return out


def test_suffix(spark, documents):
    rows = sorted((r.doc_id, r.text.encode()) for r in documents.collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        found = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in U.repeat_digests(documents).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found == plain_repeats(rows, 100)


def test_suffix_periodic_and_common(spark):
    rng = np.random.default_rng(2)
    noise = lambda n: bytes(rng.integers(97, 105, n, dtype=np.uint8)).decode()
    common = noise(130)
    texts = ["ab" * 300, "aaaa" * 100, "b" + "ab" * 200, common * 3] + [noise(int(rng.integers(0, 300))) + common[: int(rng.integers(90, 131))] + noise(50) for _ in range(60)]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(7)
    found = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in U.repeat_digests(df).collect()}
    assert found == plain_repeats([(k, t.encode()) for k, t in enumerate(texts)], 100)


def test_suffix_many_buckets(spark, documents, monkeypatch):
    whole = {tuple(r) for r in U.repeat_digests(documents).collect()}
    monkeypatch.setattr(U, "BUCKET_ROWS", 5000)
    assert {tuple(r) for r in U.repeat_digests(documents).collect()} == whole


def test_multikey_order():
    draw = np.random.default_rng(7)
    for n, kinds in ((0, 1), (1, 1), (700, 1), (700, 3), (5000, 40), (5000, 1 << 40)):
        tokens = [draw.integers(-kinds, kinds, n) for _ in range(4)]
        assert U.multikey_order(tokens, small=8).tolist() == np.lexsort(tokens[::-1]).tolist()


def test_suffix_hard(hard, empty):
    rows = U.repeat_digests(hard).collect()
    assert len(rows) == hard.count()
    long = next(r for r in rows if r.doc_id == 8)
    assert (long.n_bytes, long.n_removed, long.n_spans) == (200_000, 199_999, 1)
    assert U.repeat_digests(empty).count() == 0
