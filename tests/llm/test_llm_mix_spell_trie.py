"""Source mix, spelling groups and conversation trie against plain versions, and their edge rows."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import mixing, prefix_trie, spelling

# ---------------------------------------------------------------- source mix

DOCS = "doc_id bigint, text string, source string, __x string, size bigint, part int, n bigint"


def texts(spark, rows, partitions=4):
    return spark.createDataFrame([(*r, "x", 5, 1, 7) for r in rows], DOCS).repartition(partitions)


def plain_targets(words, weights=(3, 1, 2)):
    """Target of each source by sharing again until none is above."""
    order = sorted(words, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    left, still, target = 1.5 * sum(words.values()), set(order), {}
    while still:
        share = left / sum(weight[s] for s in still)
        over = [s for s in still if weight[s] * share > 2 * words[s]]
        if not over:
            target.update({s: weight[s] * share for s in still})
            break
        for s in over:
            target[s] = 2.0 * words[s]
            left -= target[s]
            still.remove(s)
    return target


def mix_rows(seed, n_sources, n_docs):
    rng = random.Random(seed)
    names = [None, *[f"s{i}" for i in range(n_sources - 1)]]
    heavy = rng.choice(names)
    return [
        (i, " ".join("w" for _ in range(rng.choice([0, 1, 3, 40, 700]))), heavy if rng.random() < 0.3 else rng.choice(names))
        for i in range(n_docs)
    ]


@pytest.mark.parametrize(("seed", "n_sources", "n_docs", "block"), [(1, 4, 300, 64), (2, 7, 200, 1000), (3, 150, 600, 16), (4, 1, 50, 7)])
def test_mix_meets_its_targets(spark, seed, n_sources, n_docs, block):
    rows = mix_rows(seed, n_sources, n_docs)
    mix = mixing.mix_sources(texts(spark, rows), block_words=block)
    got = mixing.document_shares(mix).collect()
    assert sorted(r["__id"] for r in got) == [r[0] for r in rows]
    words = collections.Counter()
    for _, text, source in rows:
        words[source] += len(text.split())
    target = plain_targets(words)
    taken = collections.Counter()
    for r in got:
        assert r["__words"] == words[r["__source"]] and abs(r["__target"] - target[r["__source"]]) < 1e-6
        assert 0 <= r["__taken"] <= 2 * r["__size"]
        taken[r["__source"]] += r["__taken"]
    for s, t in target.items():
        assert int(t + 1e-9) - 1 <= taken[s] <= t + 1e-6

    # the pieces of a slot lie within one block of one source and fill it end to end
    slots = collections.defaultdict(list)
    for p in mixing.pieces(mix).collect():
        slots[p["__slot"]].append(p)
    plan = {r["__slot"]: r for r in mix.slots.collect()}
    assert set(plan) == set(slots)
    for slot, parts in slots.items():
        assert len({(p["__source"], p["__round"], p["__block"]) for p in parts}) == 1
        spans = sorted((p["__low"] + p["__first"], p["__low"] + p["__end"]) for p in parts)
        assert spans[0][0] == plan[slot]["__from"] and spans[-1][1] == plan[slot]["__to"]
        assert all(a[1] == b[0] for a, b in itertools.pairwise(spans))

    # every stretch of the schedule from its start is near the weights
    total, seen = sum(target.values()), collections.Counter()
    for i, slot in enumerate(sorted(plan)):
        seen[plan[slot]["__source"]] += 1
        for s in target:
            assert abs(seen[s] - (i + 1) * target[s] / total) <= 2 * len(plan).bit_length() + 4


def test_mix_reruns_agree(spark):
    rows = mix_rows(9, 5, 150)
    got = [
        sorted(tuple(r) for r in mixing.pieces(mixing.mix_sources(texts(spark, rows[:: 1 - 2 * (p % 2)], p), block_words=50)).collect())
        for p in (1, 6)
    ]
    assert got[0] == got[1]


def test_piece_texts_are_the_words(spark):
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(37 * i)), "ab"[i % 2]) for i in range(6)]
    docs = texts(spark, rows)
    mix = mixing.mix_sources(docs, block_words=20)
    for p in mixing.piece_texts(docs, mix).collect():
        assert p["__text"].split() == rows[p["__id"]][1].split()[p["__first"] : p["__end"]]


def test_mix_edge_rows(spark):
    long = "w " * 20_000
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, "one two", "a"), (4, "one two", "a"), (None, "x y z", None), (None, None, None),
            (5, long, "b"), (6, "only", "c"), (7, None, "d")]
    got = mixing.document_shares(mixing.mix_sources(texts(spark, rows), block_words=1000)).collect()
    assert len(got) == len(rows)
    assert {(r["__id"], r["__size"]) for r in got} == {(i, len((t or "").split())) for i, t, _ in rows}
    assert all(r["__taken"] <= 2 * r["__size"] for r in got)
    assert sum(r["__taken"] for r in got if r["__source"] == "a") == int(next(r["__target"] for r in got if r["__source"] == "a"))
    empty = mixing.mix_sources(texts(spark, []))
    assert mixing.document_shares(empty).collect() == [] and mixing.pieces(empty).collect() == []
    blank = mixing.mix_sources(texts(spark, [(1, None, "a"), (2, " ", None)]))
    assert [(r["__taken"], r["__target"]) for r in mixing.document_shares(blank).collect()] == [(0, 0.0)] * 2


# ---------------------------------------------------------------- spelling groups

def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def few_letters(seed, n=250, letters="abé"):
    rng = random.Random(seed)
    words = set()
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(5, 11)))
        k = rng.randrange(len(w))
        words |= {w, w[:k] + rng.choice(letters) + w[k + rng.randint(0, 1) :]}
    return sorted(w for w in words if len(w) >= 5)


@pytest.mark.parametrize(("frequent", "long_list"), [(100, 4096), (3, 4096), (3, 2), (40, 0), (1000, 20)])
def test_all_near_pairs_are_met(spark, frequent, long_list):
    words = few_letters(frequent)
    df = spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "word string, n bigint").repartition(3)
    got = [tuple(sorted((r["u"], r["v"]))) for r in spelling.near_pairs(df, frequent, long_list).collect()]
    assert sorted(got) == sorted((a, b) for a, b in itertools.combinations(words, 2) if near(a, b))


def test_affected_grams_bound_what_an_edit_changes():
    rng = random.Random(4)
    marks = spelling._LEFT * spelling.MARKS, spelling._RIGHT * spelling.MARKS
    for _ in range(400):
        w = "".join(rng.choice("ab") for _ in range(rng.randint(5, 12)))
        frequent = {"".join(g) for size in (2, 3) for g in itertools.product("ab" + marks[0][0] + marks[1][0], repeat=size) if rng.random() < 0.5}
        grams = lambda x: collections.Counter(x[s:e] for s, e in spelling.decompose(x, frequent))  # noqa: E731,B023
        marked = marks[0] + w + marks[1]
        spans = spelling.decompose(marked, frequent)
        bound = spelling.affected(len(marked), spans)
        assert bound < len(spans)
        for k in range(len(w)):
            for other in (w[:k] + w[k + 1 :], w[:k] + rng.choice("ab") + w[k + 1 :], w[:k] + rng.choice("ab") + w[k:]):
                kept = grams(marked) & grams(marks[0] + other + marks[1])
                assert kept.total() >= len(spans) - bound


def plain_groups(docs):
    counts = collections.Counter()
    for name, text in docs:
        for r in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r)
            if name is not None:
                h = zlib.crc32(f"{name}:{w}".encode())
                if h % 97 == 0:
                    w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 5:
                counts[w] += 1
    n = {w: c for w, c in counts.items() if c >= 3}
    form, out = {}, {}
    for w in n:
        close = [v for v in n if near(w, v)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = (n[w], len(close), form[w], n[form[w]] if form[w] else None)

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (*v, root(w)) for w, v in out.items()}


def grouped(spark, docs, **k):
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in docs], "doc_id bigint, text string, word string, n int").repartition(3)
    rows = spelling.spelling_variants(df, **k).collect()
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}


def test_groups_equal_the_plain_ones(spark):
    rng = random.Random(8)
    stems = few_letters(8, 40, "aéÿz")
    docs = [(i, " ".join(rng.choice([str.upper, str, str.title])(stems[min(int(rng.expovariate(0.08)), len(stems) - 1)]) for _ in range(120))) for i in range(60)]
    for k in ({}, {"frequent": 2, "long_list": 3}):
        got = grouped(spark, docs, **k)
        assert got == plain_groups(docs) and any(v[4] not in (w, v[2]) for w, v in got.items())


def test_spelling_edge_rows(spark):
    long = "".join(random.Random(1).choice("abcdeÿ") for _ in range(3000))
    docs = [(1, None), (2, ""), (3, "12 _ \n"), (None, "words words"), (None, "words word5 wordz"), (4, "Wordz1WORDZ wordÀ"), (4, "Wordz1WORDZ wordÀ"),
            (5, f"{long} {long}x{long} {long}"), (6, f"{long} {long[1:]}"), (7, f"{long[1:]} {long[1:]} ÉTUDE étude éTUDE"), (8, "×÷×÷× ×÷×÷× ×÷×÷×")]
    got = grouped(spark, docs)
    assert got == plain_groups(docs) and len(got) >= 4
    assert grouped(spark, []) == {} and grouped(spark, [(1, None)]) == {}


# ---------------------------------------------------------------- conversation trie

def test_queue_spills_and_merges():
    rng = random.Random(3)
    queue = prefix_trie.SpillingQueue(rows=5, runs=2)
    want = collections.defaultdict(lambda: (0, 0))
    for at in range(300):
        for _ in range(rng.randint(0, 6)):
            key, values = (rng.randint(at, at + 40), rng.randint(0, 2)), (1, rng.randint(0, 9))
            queue.push(key, values)
            want[key] = tuple(x + y for x, y in zip(want[key], values))
        for b in range(3):
            assert queue.pop((at, b)) == want.pop((at, b), None)
    assert queue.spills > 20


def plain_trie(rows, family=5, most=9):
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    lead = lambda c: c - (abs(c) % family) * (1 if c >= 0 else -1)
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = tuple(own.get(lead(c), [])[:h] + ts[h:])
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
        ends[ts].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), children[k], leaves[k], saved[k],
         hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest())
        for k, m in members.items()
    )


def trie(spark, rows, **k):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id bigint, turn bigint, role string, text string, depth int, part string, n int")
    out = prefix_trie.conversation_trie(df.repartition(5), **k).collect()
    return sorted(tuple(-1 if v is None and i == 2 else v for i, v in enumerate(r)) for r in out)


def conversations(seed, n=80):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 3 * n), n):
        for t in range(rng.randint(1, 12)):
            first = "hello" if t == 0 and rng.random() < 0.6 else rng.choice(["é", "b", "cc", "", None])
            rows.append((c, t if rng.random() < 0.9 else rng.choice([None, 2]), rng.choice(["user", "user", None]), first))
    return rows


@pytest.mark.parametrize(("seed", "shards", "queue"), [(1, 8, 1000), (2, 3, 2), (3, 1, 5), (4, 40, 3)])
def test_trie_equals_the_plain_one(spark, seed, shards, queue):
    rows = conversations(seed)
    assert trie(spark, rows, shards=shards, queue_rows=queue) == plain_trie(rows)


def test_trie_edge_rows(spark):
    rows = [(None, 1, "user", "x"), (10, None, None, None), (10, None, "", ""), (10, 3, "user", "a"), (10, 3, "user", "a"), (11, 1, "user", "y" * 50_000),
            (13, 0, "a", ":b"), (14, 0, "a:", "b"), (10, 3, "assistant", "a"), (2**62 + 1, 0, "u", "z"), (-7, 5, "u", "z")]
    assert trie(spark, rows, shards=4) == plain_trie(rows)
    assert trie(spark, [(4, 0, "u", "t")], shards=2) == plain_trie([(4, 0, "u", "t")])
    assert trie(spark, [], shards=2) == [] and trie(spark, [(None, 0, "u", "t")], shards=2) == []


def test_long_and_copied_conversations(spark, monkeypatch):
    """A conversation of many blocks of the prefix sums, copies of it, and one that leaves it late; ends of one node over
    many blocks of ids."""
    monkeypatch.setattr(prefix_trie, "_TURNS", 8)
    monkeypatch.setattr(prefix_trie, "_ENDS", 50)
    long = [("user", f"t{i % 7}") for i in range(75)]
    rows = [(c, i, r, t) for c in (25, 50, 75) for i, (r, t) in enumerate(long)]
    rows += [(100, i, r, t if i != 61 else "else") for i, (r, t) in enumerate(long)]
    rows += [(c, i, "user", "t0") for c in range(1000, 1400, 5) for i in range(1 + c % 3)]
    rows += [(5 * c * 997, 0, "u", "same") for c in range(60)]
    assert trie(spark, rows, shards=4, queue_rows=10) == plain_trie(rows)


def test_no_task_gets_a_hot_first_turn(spark):
    """Light subtrees under one first turn spread over the shards."""
    rows = [(5 * c, t, "u", "hello" if t == 0 else f"{c}") for c in range(400) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    turns, convs = prefix_trie.rebuild(prefix_trie.ordered_turns(df))
    nodes = prefix_trie.prefix_trie(turns, convs, shards=16)
    assert nodes.where("n_convs = 400").count() == 2 and nodes.agg(F.max("n_leaves")).first()[0] == 400
