"""SimHash join, conversation trie and bit-plane clustering against brute force."""

import hashlib
import heapq
import random
import zlib
from collections import Counter, defaultdict
from math import floor, inf, nan

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chatprep.llm import bitplane_clustering, conversation_trie, simhash_join


# SimHash.


def plain_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                root[top(b)] = top(a)
    return {n: top(n) for n in nodes}


def simhash_rows():
    draw = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(draw.choices(words, k=draw.choice([1, 2, 3, 40, 400, 900]))) for _ in range(60)]
    texts = base + [b + " Extra" for b in base] + [b.upper() for b in base[:20]] + [None, "", " \t\n", "\x00", "é x"]
    texts += ["hot copy of one text"] * 200
    rows = list(enumerate(texts)) + [(None, base[0]), (None, "alone among null ids"), (3, "shares an id")]
    return rows


def test_simhash_against_all_pairs(spark):
    rows = simhash_rows()
    df = spark.createDataFrame([(*r, None, "x") for r in rows], "doc_id bigint, text string, print string, copies string")
    got = Counter((r["doc"], r["print"] % 2**64, r["component"]) for r in simhash_join.simhash_join(df).collect())
    prints = [(d, plain_print(t)) for d, t in rows]
    classes = plain_components({p for _, p in prints}, lambda a, b: (a ^ b).bit_count() <= 2)
    least = defaultdict(list)
    for d, p in prints:
        if d is not None:
            least[classes[p]].append(d)
    want = Counter((d, p, min(least[classes[p]], default=None)) for d, p in prints)
    assert got == want


def test_links_through_a_chain_of_bits(spark):
    draw = random.Random(1)
    prints, at = [], draw.getrandbits(64)
    for _ in range(40):  # a chain with steps of one to four bits
        prints.append(at)
        at ^= sum(1 << b for b in draw.sample(range(64), draw.choice([1, 2, 2, 3, 4])))
    prints += [draw.getrandbits(64) for _ in range(300)] + [0, 1, 2**63, 2**63 + 1, 2**64 - 1]
    signed = [(i, p - 2**64 if p >= 2**63 else p) for i, p in enumerate(prints)]
    got = {r["print"] % 2**64: r["component"] for r in simhash_join.simhash_classes(spark.createDataFrame(signed, "doc bigint, print bigint")).collect()}
    classes = plain_components(set(prints), lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for i, p in enumerate(prints):
        first[classes[p]] = min(first.get(classes[p], i), i)
    assert got == {p: first[classes[p]] for p in prints}


def test_a_variant_never_meets_more_than_its_ball(spark):
    """All 65 fingerprints around one, and many copies of them: 64 links, whatever the copies."""
    ball = [0] + [1 << b for b in range(63)]
    prints = spark.createDataFrame([(p,) for p in ball], "print bigint")
    assert simhash_join.near_prints(prints).count() <= 64 * 65
    copies = spark.createDataFrame([(i, ball[i % 64]) for i in range(6400)], "doc bigint, print bigint")
    classes = simhash_join.simhash_classes(copies).collect()
    assert {(r["copies"], r["component"]) for r in classes} == {(100, 0)}


def test_fingerprint_of_a_very_long_text():
    text = " ".join(f"w{i % 5003}" for i in range(200_000))
    assert simhash_join.fingerprint(text.encode()) == plain_print(text)


# Trie.


def plain_trie(rows, borrow):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            talks[conv].append((turn is not None, turn or 0, mark, role, text))
    talks = {c: [t[3:] for t in sorted(v)] for c, v in talks.items()}
    rebuilt = {}
    for c, own in talks.items():
        if borrow:
            h = zlib.crc32(str(c).encode()) % 6
            block = c - int(np.fmod(c, 100))
            rebuilt[c] = tuple(talks.get(block, [])[:h] + own[h:])
        else:
            rebuilt[c] = tuple(own)
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    totals = {}
    for path in sorted(members, key=len, reverse=True):
        below = [totals[c] for c in children[path]]
        own = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        totals[path] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    out = Counter()
    for path, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        out[min(convs), len(path), parent, len(convs), len(children[path]), *totals[path], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def talk_rows():
    draw = random.Random(9)
    rows = []
    for c in [*range(-30, 260), 10**12 + 7, 10**12]:
        if c in (100, 40):  # the first of a block is absent, or has no own row
            continue
        same = draw.random()
        for t in range(draw.choice([1, 1, 2, 3, 4, 7, 9])):
            text = f"turn {t}" if same < 0.5 else f"turn {t} of {draw.randrange(3)} \U0001f600"
            rows.append((c, t, "user" if t % 2 else None, text if draw.random() > 0.05 else None))
    rows += [(400 + i, t, "user", f"copied {t}") for i in range(150) for t in range(3)]  # a hot conversation
    rows += [(700, t, "user", f"long {t % 7}") for t in range(1200)]  # and a very long one
    rows += [(701, t, "user", f"long {t % 7}") for t in range(900)]
    rows += [(5, None, "user", "no number"), (5, None, None, None), (5, 0, "user", "again"), (5, 0, "user", "again")]
    rows += [(None, 0, "user", "no conversation"), (800, 0, "", ""), (801, 0, None, None), (802, 0, "user", "")]
    draw.shuffle(rows)
    return rows


def trie_of(spark, rows, partitions=4, **how):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, depth string, place int")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = conversation_trie.conversation_trie(df, **how).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(tuple(r[n] for n in names) for r in found)


@pytest.mark.parametrize("borrow, heavy, queue", [(True, 8192, 1 << 18), (True, 6, 4), (False, 40, 3)])
def test_trie_against_brute_force(spark, borrow, heavy, queue):
    """Few heavy nodes and a tiny queue: light shards, spilled messages, conversations cut by ranges."""
    rows = talk_rows()
    assert trie_of(spark, rows, 16, borrow=borrow, heavy=heavy, queue=queue) == plain_trie(rows, borrow)


def test_trie_of_turnless_conversations(spark):
    rows = [(c, 0, "user", "x") for c in range(101, 200)]  # no conversation 100: all that drop a turn are empty
    found = trie_of(spark, rows, borrow=True)
    assert found == plain_trie(rows, True)
    assert trie_of(spark, []) == Counter()


def test_pieces_of_member_lists(spark):
    rows = spark.createDataFrame([(i, 1, 7, 8, True) for i in range(5000)], "conv_id bigint, depth bigint, kx bigint, ky bigint, last boolean")
    lengths = spark.createDataFrame([(i, 0) for i in range(9000, 9100)], "conv_id bigint, length bigint")
    got = {r["depth"]: r["ends_sha256"] for r in conversation_trie.end_digests(rows, lengths, 60).collect()}
    assert got == {
        1: hashlib.sha256(",".join(map(str, range(5000))).encode()).hexdigest(),
        0: hashlib.sha256(",".join(map(str, range(9000, 9100))).encode()).hexdigest(),
    }


def test_spilling_queue_keeps_the_order():
    draw, queue, plain = random.Random(2), conversation_trie.SpillingQueue(8), []
    for step in range(3000):
        level = -step // 100
        key = (3000 + level, draw.randrange(50), 0)
        queue.push(key, (1, step, 2))
        heapq.heappush(plain, (key, step))
    assert queue.runs and len(queue.heap) <= 8
    while plain:
        key = plain[0][0]
        steps = []
        while plain and plain[0][0] == key:
            steps.append(heapq.heappop(plain)[1])
        assert queue.take((key[0], key[1] - 0, key[2])) == (len(steps), sum(steps), 2 * len(steps))
    assert not queue.runs and not queue.heap


# Clustering.


def plain_clusters(rows, k, rounds):
    kept = [(i, [floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and abs(x) < inf for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [list(v) for _, v in start[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for n, vs in groups.items():
            centres[n] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    own = Counter()
    for _, c, gap in found:
        own[c] += gap
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, c, gap, own[c], sum(own.values()), marks[c]) for i, c, gap in found)


def vector_rows():
    draw = random.Random(6)
    rows = [(i, [draw.gauss(draw.randrange(4), 0.3) for _ in range(64)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # one hot vector
    rows += [(2000 + i, [draw.uniform(-3000, 3000) for _ in range(64)]) for i in range(3)]
    rows += [(3000, [0.0] * 64), (3001, [-1 / 1024] * 64), (3002, [-1e-9] * 64), (0, rows[1][1]), (None, rows[2][1]), (None, None)]
    rows += [(4000, []), (4001, [1.0] * 63), (4002, [1.0] * 65), (4003, [nan] + [1.0] * 63), (4004, [inf] + [1.0] * 63), (4005, [None] + [1.0] * 63)]
    return rows


def clusters_of(spark, rows, kind="double", k=8, rounds=10):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"vec_id bigint, embedding array<{kind}>, cluster int, planes string")
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return Counter(tuple(r[n] for n in names) for r in bitplane_clustering.cluster_vectors(df, k=k, rounds=rounds).collect())


@pytest.mark.parametrize("k, rounds", [(8, 10), (3, 1), (5, 0)])
def test_clusters_against_brute_force(spark, k, rounds):
    rows = vector_rows()
    assert clusters_of(spark, rows, k=k, rounds=rounds) == plain_clusters(rows, k, rounds)


def test_fewer_vectors_than_centroids(spark):
    rows = [(i, [float(np.float32(0.1 * i + j)) for j in range(64)]) for i in range(3)] * 2
    assert clusters_of(spark, rows, "float") == plain_clusters(rows, 8, 10)
    assert clusters_of(spark, [(1, [1.0])]) == Counter()


def test_components_beyond_the_range_are_told(spark):
    with pytest.raises(Exception, match="would not fit"):
        clusters_of(spark, [(1, [1e30] * 64)])


def test_planes_give_the_vectors_back_and_exact_products():
    draw = np.random.default_rng(3)
    a, c = draw.integers(-5000, 5000, (50, 64)), draw.integers(-300, 300, 64)
    planes = bitplane_clustering.pack(a)
    assert planes.shape[1] == 14 and (bitplane_clustering.unpack(planes) == a).all()
    assert (bitplane_clustering.inner_products(planes, bitplane_clustering.pack(c[None])[0]) == a @ c).all()
    assert (bitplane_clustering.norms(planes) == (a * a).sum(axis=1)).all()


def test_sql_of_new_operators_on_odd_rows(spark, tmp_path):
    con = duckdb.connect()
    spark.createDataFrame(talk_rows(), "conv_id bigint, turn bigint, role string, text string").filter("conv_id < 600").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame(vector_rows(), "vec_id bigint, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    for query, sql, table in (
        (conversation_trie.op12_conversation_trie, conversation_trie.ORACLE, "conversations"),
        (bitplane_clustering.op13_bitplane_clustering, bitplane_clustering.ORACLE, "embeddings"),
    ):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
        got = query(spark, str(tmp_path))
        result = con.execute(sql)
        names = [d[0] for d in result.description]
        want = Counter(repr([r[names.index(c)] for c in got.columns]) for r in result.fetchall())
        assert Counter(repr([r[c] for c in got.columns]) for r in got.collect()) == want


def test_fingerprints_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "doc_id bigint, text string")
    assert {(r["doc"], r["print"], r["component"]) for r in simhash_join.simhash_join(df).collect()} == {(1, 0, 1), (None, 0, 1)}
    only = df.filter(F.col("doc_id").isNull())
    assert [(r["doc"], r["component"]) for r in simhash_join.simhash_join(only).collect()] == [(None, None)]
