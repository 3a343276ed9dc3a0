"""Operators against plain versions on small random inputs, and by measured accuracy."""

import collections
import itertools
import random
import re

import numpy as np
import pytest

from ledgerlens.llm import chunks, decontaminate, licenses, ngram_join, pieces, quality, secrets, topk, toxicity, urls
from ledgerlens.llm.components import components
from ledgerlens.llm.parameters import PIECE_MODEL

SMALL, MIDDLE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def union_find(pairs, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_copies(seed, groups=12, copies=14, n_words=120, vocabulary=4000):
    """Groups of texts with a few words changed, texts with a shared passage, and very short ones."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passage = [word() for _ in range(60)]
    texts = []
    for g in range(groups):
        base = [word() for _ in range(rng.randint(5, n_words))]
        if g % 3 == 0:
            base = base[: len(base) // 3] + passage + base[len(base) // 3 :]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4])):
                own[rng.randrange(len(own))] = word()
            if rng.random() < 0.3:
                own = own + [word() for _ in range(rng.randint(1, 8))]
            texts.append(" ".join(own))
    texts += [" ".join(passage[: rng.randint(50, 60)]) for _ in range(25)]
    texts += [" ".join([f"s{rng.randrange(2)}"] * rng.randint(1, 7)) for _ in range(30)]
    rng.shuffle(texts)
    return texts


def brute_components(texts):
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    links = [
        (i, j) for i, j in itertools.combinations(range(len(texts)), 2) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    return {i: (len(sets[i]), r) for i, r in union_find(links, range(len(texts))).items()}


@pytest.mark.parametrize("floor, short, block", [(16, 16, 512), (3, 3, 4), (1, 1, 7)])
def test_ngram_join_equals_all_pairs(spark, monkeypatch, floor, short, block):
    """Also where most tokens count as frequent and are indexed as pairs, and lists are long."""
    monkeypatch.setattr(ngram_join, "SHORT", short)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = near_copies(floor)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    rows, links = ngram_join.join_sets(docs, frequent=0.0, least_frequent=floor)
    got = {r["doc_id"]: (r["__n"], r["__component"]) for r in rows.collect()}
    assert got == brute_components(texts)


def test_signatures_of_partners_meet():
    """Sets that are linked share a signature, whatever tokens are frequent."""
    rng = np.random.default_rng(5)
    for trial in range(300):
        n = int(rng.integers(1, 120))
        base = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        lost = int(rng.integers(0, len(base) // 5 + 1))
        other = np.unique(np.concatenate([rng.permutation(base)[lost:], rng.integers(0, 1 << 63, int(rng.integers(0, n // 5 + 1))).astype(np.uint64)]))
        common = len(np.intersect1d(base, other))
        if 100 * common < 80 * (len(base) + len(other) - common):
            continue
        frequent = np.sort(rng.permutation(np.union1d(base, other))[: int(rng.integers(0, len(base) + 1))])
        if len(base) == len(other) == common:
            continue  # equal sets are one node
        mine, theirs = ngram_join.signatures(base, frequent), ngram_join.signatures(other, frequent)
        assert any(len(np.intersect1d(a, b)) for a, b in zip(mine, theirs, strict=True)), trial


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(6)
    for _ in range(300):
        base = rng.integers(0, 1 << 63, int(rng.integers(1, 900))).astype(np.uint64)
        a = np.unique(base[rng.random(len(base)) < 0.9])
        b = np.unique(np.concatenate([base[rng.random(len(base)) < 0.9], rng.integers(0, 1 << 63, int(rng.integers(0, 50))).astype(np.uint64)]))
        if len(a) and len(b):
            apart = len(np.setxor1d(a, b))
            for x, y in zip(ngram_join.parity_sketches(a), ngram_join.parity_sketches(b), strict=True):
                assert ngram_join.least_difference(x, y) <= apart
    far = [np.unique(rng.integers(0, 1 << 63, 400).astype(np.uint64)) for _ in range(2)]
    assert 9 * ngram_join.least_difference(*[ngram_join.parity_sketches(x)[0] for x in far]) > 800


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 150), (150, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    want = {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 150: 150, 200: 150}
    assert got == want


def test_chunks_resist_insertions():
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(2000)).encode()
    moved = text[:5000] + b"inserted " + text[5000:]
    a, b = chunks.chunk_rows(text)[0], chunks.chunk_rows(moved)[0]
    assert len(set(a) - set(b)) <= 4 and len(a) > 150
    sizes = np.diff(np.concatenate(([0], chunks.cut_ends(np.frombuffer(text, np.uint8)))))
    assert sizes[:-1].min() > chunks.RADIUS and sizes.max() < 400


def test_gear_hash_is_the_rolling_one():
    data = np.frombuffer(random.Random(4).randbytes(500), np.uint8)
    h, want = 0, []
    for byte in data:
        h = ((h << 1) + int(chunks.GEAR[byte])) & 0xFFFF
        want.append(h)
    assert chunks.gear_hashes(data).tolist() == want


def test_chunks_cover_the_text():
    for text in ("", "a", "ä" * 300, "plain words " * 50, "日本語テキスト" * 40):
        if text:
            digests, starts, ends, words = chunks.chunk_rows(text.encode())
            assert starts[0] == 0 and ends[-1] == len(text) and list(starts[1:]) == list(ends[:-1])
            assert sum(words) == len(text.split())


def test_shared_passages_are_found(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 9)))
    text = lambda n: [word() for _ in range(n)]
    rows, want = [], set()
    for p in range(30):
        passage = text(rng.randint(51, 90))
        for c in range(3):
            own = text(rng.randint(20, 300))
            at = rng.randrange(len(own))
            rows.append((p * 10 + c, " ".join(own[:at] + passage + own[at:])))
            want.add(p * 10 + c)
    clean = {1000 + i for i in range(60)}
    rows += [(i, " ".join(text(200))) for i in sorted(clean)]
    found = {r["doc_id"] for r in chunks.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found >= want and not found & clean


def common_passages(a, b, least):
    """[start, end) in words of ``a`` of the longest stretches of ``least`` words or more that ``b`` has too."""
    places = collections.defaultdict(list)
    for j in range(len(b) - least + 1):
        places[tuple(b[j : j + least])].append(j)
    out = []
    for i in range(len(a) - least + 1):
        for j in places[tuple(a[i : i + least])]:
            if i and j and a[i - 1] == b[j - 1]:
                continue
            n = least
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            out.append((i, i + n))
    return out


def blocks_of_passages(seed, n_docs=60, n_passages=14):
    """Documents made of passages in many orders, with words of their own between some of them."""
    rng = random.Random(seed)
    made = itertools.count()
    word = lambda: f"{''.join(rng.choice('etaoinshr') for _ in range(rng.randint(1, 6)))}{next(made)}"
    passages = [[word() for _ in range(rng.randint(15, 90))] for _ in range(n_passages)]
    docs = []
    for _ in range(n_docs):
        own = []
        for p in rng.sample(range(n_passages), rng.randint(1, 5)):
            own += passages[p]
            if rng.random() < 0.4:
                own += [word() for _ in range(rng.randint(1, 40))]
        docs.append(own)
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_equal_all_pairs(spark, seed):
    """Every stretch of 51 words or more that two documents share is reported in both, as far as it goes."""
    docs = blocks_of_passages(seed)
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    found = collections.defaultdict(list)
    for r in chunks.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect():
        found[r["doc_id"]].append((r["start"], r["end"]))
        for p in r["parts"]:
            assert r["start"] <= p["start"] < p["end"] <= r["end"] and p["keeper"] <= r["doc_id"]
            assert rows[r["doc_id"]][1][p["start"] : p["end"]] in rows[p["keeper"]][1]
    for i, a in enumerate(docs):
        starts = list(itertools.accumulate([len(w) + 1 for w in a], initial=0))
        covered = set().union(*[range(x, y) for x, y in found[i]])
        for j, b in enumerate(docs):
            if i != j:
                for low, high in common_passages(a, b, 51):
                    # an end that agrees with neither compared document may lack a few words
                    middle = range(starts[low + 8], starts[high - 8])
                    assert covered.issuperset(middle), (i, j, low, high)


def test_no_passage_is_removed_everywhere(spark):
    """Documents ABC, BCD and ABCD; and many orders of passages: each word stays somewhere."""
    rng = random.Random(3)
    made = itertools.count()
    block = lambda: [f"{rng.choice('abcdefgh')}{next(made)}x{rng.randrange(10**rng.randint(1, 5))}" for _ in range(45)]
    a, b, c, d = block(), block(), block(), block()
    small = [[*a, *b, *c], [*b, *c, *d], [*a, *b, *c, *d]]
    for docs in (small, small[::-1], blocks_of_passages(5), blocks_of_passages(6, 100, 6)):
        frame = spark.createDataFrame([(i, " ".join(w), "x") for i, w in enumerate(docs)], "doc_id bigint, text string, parts string").repartition(3)
        left = {r["doc_id"]: r["text"] for r in chunks.remove_repeats(frame, chunks.repeated_passages(frame)).collect()}
        assert set(left) == set(range(len(docs)))
        kept = set().union(*[t.split() for t in left.values()])
        assert kept == set().union(*docs)
        for i, w in enumerate(docs):  # whole words in their order
            rest = iter(w)
            assert all(x in rest for x in left[i].split())
        assert sum(len(t) for t in left.values()) < 0.75 * sum(len(" ".join(w)) for w in docs)


def test_without_words():
    assert chunks.without_words("one two three four five", [(2, 16)]) == "one four five"
    assert chunks.without_words("one two", [(0, 7)]) == "one two"
    assert chunks.without_words("a b c d e f", [(0, 5), (4, 11)]) == "a c f"


@pytest.mark.parametrize("longest", [3, 9])
def test_all_planted_passages_are_found_whole(spark, longest):
    """Short words too, and each passage from its first to its last word."""
    rng = random.Random(longest)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, longest)))
    text = lambda n: [word() for _ in range(n)]
    rows, want = [], {}
    for p in range(150):
        passage = text(rng.randint(51, 56))
        for c in range(3):
            own = text(rng.randint(20, 200))
            at = rng.randrange(1, len(own))
            rows.append((p * 10 + c, " ".join(own[:at] + passage + own[at:])))
            start = len(" ".join(own[:at])) + 1
            want[p * 10 + c] = (start, start + len(" ".join(passage)))
    found = chunks.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    got = {i: [r for r in found if r["doc_id"] == i] for i in want}
    for i, (start, end) in want.items():
        assert any(r["start"] <= start and r["end"] >= end for r in got[i]), i
        assert all(r["start"] > start - 20 and r["end"] < end + 20 and r["n_words"] >= 51 for r in got[i]), i


def test_extension_is_the_common_part():
    assert chunks.extension(b"one two three", b"xx two three", True) == (10, 2)
    assert chunks.extension(b". two threes, ", b". two three", False) == (10, 1)
    assert chunks.extension("xé".encode(), "xè".encode(), False) == (0, 0)


def test_secret_spans_equal_a_plain_scan(spark):
    rng = random.Random(2)
    bits = ["password=", "Token: ", "api_key = '", "apikey:\"", "AKIA", "ABCDEFGH12", "deadbeef", "0123456789abcdef", "äö", " ", "\n", "secret=secret: ", "xyzXYZ123+/=", "user=bob", "https://a.b/c", "AbC123" * 5, "passwd"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["__spans"] or [] for r in secrets.find_secrets(docs).collect()}
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
    for i, text in enumerate(texts):
        base = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 12]
        base += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        base += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        assert [tuple(s) for s in got[i] if s["kind"] in secrets.BASE] == sorted(base), text


def test_weak_parts_need_their_complement(spark):
    weak, strong = "AKIAABCDEFGH12", "password=abcdefghijkl99"
    rows = [(1, weak), (2, weak + " " + strong), (3, weak + " " * 300 + strong), (4, strong + " " * 150 + weak), (5, "user=bob"), (6, "user=bob " + strong), (7, "https://host.example/x"), (8, "https://host.example/x " + strong)]
    got = {r["doc_id"]: [s["kind"] for s in r["__spans"] or []] for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: [], 2: ["short_access", "assign"], 3: ["assign"], 4: ["assign", "short_access"], 5: [], 6: ["account", "assign"], 7: [], 8: ["endpoint", "assign"]}
    masked = {r["doc_id"]: r["text"] for r in secrets.mask_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert masked[2] == "[SECRET] [SECRET]" and masked[1] == weak and masked[5] == "user=bob"
    assert masked[8] == "https://host.example/x [SECRET]"  # an endpoint is no secret


def test_parts_do_not_prove_themselves(spark):
    """A complement shares no code point with the part, and a token in an endpoint or an account is no secret."""
    path = "https://example.com/ABCdef123/ABCdef123/ABCdef123456"
    token = "AbCdEfGhIjKlMnOpQrStUvWx12"
    strong = "password=abcdefghijkl99"
    rows = [
        (1, path), (2, f"user={token}"), (3, f"{path} user=bob"), (4, f"user=bob {token}"), (5, f"{path} {strong}"),
        (6, f"user={token} {strong}"), (7, f"https://h.example/{'0123456789abcdef' * 2}"), (8, f"login: {token} user=bob"),
        (9, f"user=abc {token}/x{token}"), (10, f"s3://bucket/{token} AKIAABCDEFGH12"),
    ]
    got = {r["doc_id"]: [s["kind"] for s in r["__spans"] or []] for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {
        1: [], 2: [], 3: [], 4: ["account", "mixed_token"], 5: ["endpoint", "assign"], 6: ["account", "assign"], 7: ["hex"], 8: [],
        9: ["account", "mixed_token"], 10: [],
    }
    masked = {r["doc_id"]: r["text"] for r in secrets.mask_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert masked[1] == path and masked[3] == rows[2][1] and masked[5] == f"{path} [SECRET]"


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(pieces.read_model(PIECE_MODEL))


def test_nbest_equals_all_segmentations(model):
    def every(segment):
        out = []

        def go(at, score, ids):
            if at == len(segment):
                out.append((score, ids))
            else:
                for end, s, own in model.edges(segment, at, False):
                    go(end, score + s, ids + own)

        go(0, 0.0, ())
        return sorted(out, key=lambda x: -x[0])

    segments = ["▁the", "▁tionsh", "▁ñéç日x", "a", "▁▁▁", "日", "▁other"]
    for segment, packed, best, loss in zip(segments, *model.solve(segments), strict=True):
        want = every(segment)
        got = model.nbest(segment, 6)
        assert [s for s, _ in got] == [s for s, _ in want[:6]] and len({i for _, i in got}) == len(got)
        assert best == want[0][0] and tuple(np.frombuffer(packed, np.int32)) == got[0][1]
        assert loss == (want[0][0] - want[1][0] if len(want) > 1 else float("inf"))


def test_each_beginning_is_found_at_one_place(model):
    """The lookup of a state and character reads one place of a table: all beginnings are there, nothing else is."""
    size = len(model.move_keys)
    assert size == model.mask + 1 and (model.move_keys >= 0).sum() == len(model.begins)
    found = [(b, model.begins[b[:-1]] if len(b) > 1 else 0, ord(b[-1])) for b in model.begins]
    state, chars = (np.array([f[k] for f in found], np.int64) for k in (1, 2))
    place = (model.move_shift[state] + chars) % size
    assert (model.move_keys[place] == (state << 21 | chars)).all()
    assert model.move_to[place].tolist() == list(model.begins.values())
    # characters that fall on the places of others: a whole table further
    text = "".join(chr(c + size) for c in (ord("a"), ord("▁"), ord("日")))
    codes = np.array([ord(c) for c in text], np.int64)
    starts, ends, ids, _ = model._lattices(codes, np.full(3, 3))
    assert starts.tolist() == [0, 1, 2] and ends.tolist() == [1, 2, 3] and ids.tolist() == [-1] * 3


def test_solved_in_groups_like_one_by_one(model, monkeypatch):
    """Few segments together, long ones between, and numbers that begin anew give the results of an encoder a text."""
    texts = ["the cat sat\non the mat " + "y" * 100 + " the end", "the other cat", "日本 語 " + "z" * 70, "", "the cat sat"]
    want = [pieces.Encoder(model, 3).encode_all([t])[0] for t in texts]
    monkeypatch.setattr(pieces, "_SOLVED_TOGETHER", 2)
    monkeypatch.setattr(pieces, "_MEMO", 6)
    encoder = pieces.Encoder(model, 3)
    assert encoder.encode_all(texts) == want
    assert [encoder.encode_all([t])[0] for t in texts] == want and len(encoder.packed) == len(encoder.known)


def test_nbest_of_texts(model):
    for text in ("", " ", "▁", "a▁ b\n\n▁▁", "\n", "  x  ", "日本▁語 😀", "x" * 300, "the cat sat\non the mat"):
        for n in (1, 2, 5):
            encoder = pieces.Encoder(model, n)
            packed, score, scores = encoder.encode([text])[0]
            found = encoder.nbest(text)
            assert [s for s, _ in found] == scores and scores[0] == score and scores == sorted(scores, reverse=True)
            assert found[0][1] == np.frombuffer(packed, np.int32).tolist()
            assert all(model.decode(i) == text for _, i in found)
    whole = "▁the▁cat\nsat"
    assert [s for s, _ in model.nbest(whole, 6)] == [s for s, _ in pieces.Encoder(model, 6).nbest("the cat\nsat")]


def test_two_best_come_from_the_search(spark, model, monkeypatch):
    """Also for N = 2: A-star opens a segment of every text, and all N segmentations are returned."""
    searched, nbest = [], pieces.Pieces.nbest
    monkeypatch.setattr(pieces.Pieces, "nbest", lambda self, segment, n, plain=False: searched.append(segment) or nbest(self, segment, n, plain))
    texts = ["the cat sat\non the mat", "  two  blanks", "日本▁語 😀 and more", "x" * 300]
    for text, (score, scores, ids) in zip(texts, pieces.Encoder(model, 2).encode_all(texts), strict=True):
        segments = pieces.Encoder(model, 2)._segments(text)
        assert set(searched) & set(segments)
        loss = min(model.solve([x])[2][0] for x in segments if x != pieces._OWN_BLANK)  # two-best Viterbi
        assert scores == [score, score - loss] and len(set(ids)) == 2
        for s, own in zip(scores, ids, strict=True):
            own = np.frombuffer(own, np.int32).tolist()
            costs = [model.byte_score if i in model.byte_ids.values() else model.scores[i] for i in own]
            assert sum(costs) == s and model.decode(own) == text
    docs = spark.createDataFrame(list(enumerate([*texts, None, ""])), "doc_id bigint, text string")
    rows = pieces.encode_texts(docs, model, n=3).orderBy("doc_id").collect()
    for r in rows[:4]:
        want = [own for _, own in pieces.Encoder(model, 3).nbest(r["text"])]
        assert [list(r["__ids"]), *map(list, r["__next_ids"])] == want and len(want) == 3
    assert rows[4]["__next_ids"] is None and rows[5]["__next_ids"] == []


def test_op2_has_the_second_segmentation(spark, model):
    import hashlib

    import __spark_entry__ as entry

    rows = {r["doc_id"]: r for r in entry.queries()["op2_sentencepiece"](spark, "/root/testdata/sf0.001").collect()}
    encoder = pieces.Encoder(model, 2)
    for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20).collect():
        second = np.array(encoder.nbest(d["text"])[1][1], np.int32).tobytes()
        assert rows[d["doc_id"]]["second_ids_sha256"] == hashlib.sha256(second).hexdigest() != rows[d["doc_id"]]["ids_sha256"]


def test_round_trip_of_documents(spark):
    import __spark_entry__ as entry

    rows = entry.queries()["op2_sentencepiece"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r["round_trip"] for r in rows)
    assert all(r["second_score"] is None or r["second_score"] <= r["score"] for r in rows)


def test_op2_decodes_the_second_segmentation(spark, model, scratch):
    """Both segmentations are counted and spelled back to the text, not the best alone."""
    from ledgerlens.llm.queries import op2_sentencepiece

    texts = ["the cat sat\non the mat", "  two  blanks", "日本▁語 😀 and more", "x" * 300, "", None, "the cat sat\non the mat"]
    docs = spark.createDataFrame([(k // 2, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    docs.write.parquet(f"{scratch}/documents.parquet")
    rows = op2_sentencepiece(spark, scratch).collect()
    want = []
    for k, t in enumerate(texts):
        found = pieces.Encoder(model, 2).nbest(t) if t else []
        second = (len(found[1][1]), True) if len(found) > 1 else (None, None)
        want.append((k // 2, None if t is None else len(found[0][1]) if t else 0, True, *second))
    got = [(r["doc_id"], r["n_pieces"], r["round_trip"], r["second_n_pieces"], r["second_round_trip"]) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, want)) and sum(w[4] is True for w in want) == 5
    # a segmentation that spells another text does not pass
    wrong = spark.createDataFrame([([bytearray(b""), None],), (None,), ([],)], "x array<binary>")
    assert [r["__decoded"] for r in pieces.decode_ids(wrong, model, "x").collect()] == [["", None], None, []]


def test_searches_in_step_give_the_first_two_paths(model):
    """Every segment is searched for its second path, with equal scores too, not only the one that a text opens."""
    import random

    rng = random.Random(5)
    equal = pieces.Pieces([(p, float(-rng.randint(1, 3)) if kind == 1 else s, kind) for p, s, kind in pieces.read_model(PIECE_MODEL)])
    segments = ["▁" + "".join(rng.choices("thereonaisñ日", k=rng.randint(0, 14))) for _ in range(300)]
    for m in (model, equal):
        for segment, packed, best, loss in zip(segments, *m.solve(segments), strict=True):
            paths = m.nbest(segment, 2)
            assert (best, tuple(np.frombuffer(packed, np.int32))) == paths[0]
            assert loss == (paths[0][0] - paths[1][0] if len(paths) > 1 else float("inf"))


def test_top_k_equals_all_products():
    rng = np.random.default_rng(1)
    for n, width, most in ((1, 3, 5), (4, 3, 5), (700, 3, 3), (2000, 8, 20), (900, 4, 1), (600, 5, 10**8)):
        vectors, ids = rng.integers(-most, most + 1, (n, width)), rng.permutation(n).astype(np.int64) - 5
        if n > 100:
            vectors[:150] = vectors[0]  # ties
        own, queries = ids[::7], vectors[::7]
        got_ids, got = topk.MTree(ids, vectors, page=32).search(queries, 5, own)
        for r, (query, mine) in enumerate(zip(queries, own, strict=True)):
            products = vectors @ query
            others = np.flatnonzero(ids != mine)
            best = others[np.lexsort((ids[others], -products[others]))][:5]
            assert got_ids[r][: len(best)].tolist() == ids[best].tolist() and got[r][: len(best)].tolist() == products[best].tolist()


def test_top_k_over_blocks(spark):
    rng = np.random.default_rng(2)
    vectors = rng.integers(-9, 10, (400, 6))
    frame = spark.createDataFrame([(i, [int(x) for x in v]) for i, v in enumerate(vectors)], "vec_id bigint, vector array<bigint>")
    got = topk.exact_top_k(frame, frame.where("vec_id % 10 = 0"), k=4, block_rows=90, query_rows=15, page=16).collect()
    assert len(got) == 160
    for r in got:
        products = vectors @ vectors[r["query_id"]]
        others = np.array([i for i in range(400) if i != r["query_id"]])
        assert others[np.lexsort((others, -products[others]))][r["rank"] - 1] == r["vec_id"]


def test_top_k_keeps_repeated_rows(spark):
    """Rows that repeat take as many places, and rows with the query's id cost no other candidate."""
    rng = random.Random(12)
    rows = []
    for i in range(60):
        v = [rng.randint(-3, 3) for _ in range(4)]
        rows += [(i, v)] * rng.choice([1, 1, 2, 7])
    rows += [(0, [9, 9, 9, 9])] * 4 + [(0, [8, 8, 8, 8]), (1, [9, 9, 9, 9]), (1, [9, 9, 9, 9]), (1, [0, 0, 0, 1])]
    frame = spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>").repartition(3)
    asked = frame.where("vec_id IN (10, 20, 30)").unionAll(spark.createDataFrame([(0, [9, 9, 9, 9])] * 2, frame.schema))
    got = collections.defaultdict(list)
    for r in topk.exact_top_k(frame, asked, k=5, block_rows=20, query_rows=2, page=4).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    for query in (0, 10, 20, 30):
        q = [9] * 4 if query == 0 else next(v for i, v in rows if i == query)
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), i) for i, v in rows if i != query)
        assert got[query] == [(i, -s) for s, i in scored[:5]]


def test_urls_equal_all_rules(spark):
    rng = random.Random(6)
    hosts = ["a.b.c", "b.c", "c", "x.b.c", "bc", "b.cc", "", "a..c", "c.", "B.C"]
    paths = ["", "/", "/p", "/p/q", "/pq", "?x=1", "/p#y", "/p/q/r?z"]
    rules = [(rng.choice(["block", "allow"]), h, p) for h in ("c", "b.c", "a.b.c", "cc") for p in ("/", "/p", "/p/q", "") if rng.random() < 0.7]
    rows = [(i, rng.choice(["http://", "https://", ""]) + rng.choice(hosts) + rng.choice(paths)) for i in range(400)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string").repartition(3)
    known = {(h, p): v for v, h, p in reversed(rules)}
    for block in (1000, 2):
        for r in urls.judge_urls(frame, rules, block_rules=block).collect():
            url = r["url"]
            host, path = "", ""
            if "://" in url:
                host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
                host = host.lower()
            fits = [(len(h) + len(p), len(h), h + p, v) for (h, p), v in known.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
            want = max(fits)[2:] if fits else (None, "allow")
            assert (r["__host"], r["__path"], r["__rule"], r["__verdict"]) == (host, path, *want), url


def test_decontamination_in_several_automata(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 10, 12, 25])))) for i in range(12)]
    docs = []
    for i in range(60):
        own = [rng.choice(words) for _ in range(40)]
        if i % 2:
            piece = rng.choice(items)[1].split()
            own[5:5] = piece[: rng.randint(3, len(piece))]
        docs.append((i, "é, ".join(own) if i % 5 == 0 else " -".join(own).upper()))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    one = {r["doc_id"]: r for r in decontaminate.decontaminate(frame, bench).collect()}
    many = {r["doc_id"]: r for r in decontaminate.decontaminate(frame, bench, block_bytes=400).collect()}
    assert {i: r["__spans"] for i, r in one.items()} == {i: r["__spans"] for i, r in many.items()}
    for i, text in docs:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        hit, found = set(), set()
        for item, t in items:
            w = t.split()
            for s in range(max(1, len(w) - 9)):
                part = w[s : s + 10]
                for at in range(len(own) - len(part) + 1):
                    if own[at : at + len(part)] == part:
                        hit.update(range(at, at + len(part)))
                        found.add(str(item))
        for r in (one[i], many[i]):
            assert (r["__n_words"], r["__n_hit"], r["__items"]) == (len(own), len(hit), sorted(found))
        covered = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ".join(text.lower()[s["start"] : s["end"]] for s in one[i]["__spans"]))
        assert covered == [own[k] for k in sorted(hit)]


def test_toxicity_on_held_out_rows(spark):
    import __spark_entry__ as entry

    scored = entry.queries()["op6_toxicity"](spark, MIDDLE)
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").select("doc_id", "toxic")
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    good = sum(r["predicted"] == r["toxic"] for r in rows)
    assert good >= 0.97 * len(rows)
    toxic = [r for r in rows if r["toxic"] == 1]
    assert sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic)


def test_folding():
    assert toxicity.folded_words("1d10t! Mоrоn, stυpid|x !! 5cum") == ["idiot", "moron", "stupidix", "scum"]
    lexicon = toxicity.Lexicon({"scum$": 3.0, "lowe": 2.0}, ["pond scum"], [0.0] * 4)
    automaton = lexicon.automaton()
    assert len(toxicity.hits(["a", "scum", "lower", "scumm"], automaton)) == 2
    assert not toxicity.hits(["pond", "scum"], automaton) and toxicity.hits(["pond", "scum", "scum"], automaton)


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    fitted = quality.fit_quality(docs, labels.where("doc_id % 3 <> 0"))
    rows = quality.score_quality(docs, fitted).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    right = sum((r["__score"] >= quality.KEEP) == (r["quality"] == 1) for r in rows)
    assert len(rows) > 50 and right >= 0.95 * len(rows)


def test_co_training_learns_from_the_other_view():
    """The metadata view has few labels; the text view's pseudo-labels teach it."""
    rng = np.random.default_rng(3)
    y = np.arange(40) % 2.0
    xt, ut = np.column_stack([y + rng.normal(0, 0.05, 40)]), rng.integers(0, 2, 2000).astype(float)
    um = np.column_stack([ut * 1.0, 1 - ut])
    xm = np.full((40, 2), 0.5)  # says nothing about the labelled rows
    held = np.arange(40) % 4 < 2
    alone = quality.co_train(xt, xm, y, held, np.empty((0, 1)), np.empty((0, 2)))
    taught = quality.co_train(xt, xm, y, held, ut[:, None], um)
    gain = lambda m: m.meta[1] - m.meta[2]
    assert gain(taught) > 2 and gain(taught) > gain(alone) + 1


def test_all_unlabelled_documents_are_exchanged(spark):
    """The pool in Spark labels and sums up like one in memory, and none is left out."""
    rng = np.random.default_rng(9)
    n, k = 30_000, len(quality.TEXT_FEATURES)
    kinds = rng.integers(0, 2, n + 400)
    text = rng.random((n + 400, k)) * 0.2 + kinds[:, None] * 0.5
    slots = np.column_stack([kinds, 64 + rng.integers(0, 5, n + 400), 128 + rng.integers(0, 9, n + 400)])
    columns = ", ".join([*[f"__m{i} int" for i in range(3)], *[f"{c} double" for c in quality.TEXT_FEATURES]])
    rows = [(*map(int, a), *map(float, b)) for a, b in zip(slots[400:], text[400:], strict=True)]
    pool = quality.SparkPool(spark.createDataFrame(rows, columns).repartition(3))
    y, held = kinds[:400].astype(float), np.arange(400) % 4 == 0
    here = quality.LocalPool(text[400:], slots[400:])
    a, b = (quality.co_train_over(p, text[:400], slots[:400], y, held) for p in (pool, here))
    for own, other in ((a.text, b.text), (a.meta, b.meta), (a.mix, b.mix)):
        assert np.allclose(own, other, rtol=1e-6, atol=1e-6)
    sure = [(a.text, 0.5, 0.5)]
    assert pool.taught("meta", sure, np.ones(152))[0] == n  # far more than any sample
    assert quality.SAMPLE_ROWS == 20_000


@pytest.fixture(scope="module")
def fitted_licenses():
    features = licenses.template_features(licenses.TEMPLATES)
    plain = [f"plain words of text number {i} in the".encode().split() for i in range(200)]
    return licenses.train([licenses.numbered(w, features) for w in plain], sorted({x for w in plain for x in w}))


def test_notices_in_long_lines(fitted_licenses):
    """A notice of every template is found in a line of thousands of words, where it stands."""
    rng = random.Random(4)
    filler = lambda n: " ".join("".join(rng.choice("bcdfgklmzé") for _ in range(rng.randint(2, 8))) for _ in range(n))
    for family, texts in licenses.TEMPLATES.items():
        for t in texts:
            for before, after in ((480, 0), (0, 480), (233, 251), (3000, 2500)):
                line = f"{filler(before)} {t} {filler(after)}"
                found = licenses.notices(f"one\n{line}\ntwo".encode(), fitted_licenses, {})
                good = [n for n in found if n[2] == family and n[4] >= licenses.MIN_SIMILARITY]
                assert len(good) == 1, (family, t, before, found)
                words = licenses.words_of(t.encode())
                own = licenses.words_of(f"one\n{line}"[good[0][0] : good[0][1]].encode())
                assert set(own) <= set(words) and len(own) >= 0.6 * len(words)
    assert not [n for n in licenses.notices(filler(5000).encode(), fitted_licenses, {})]


def test_license_families(fitted_licenses):
    fitted = fitted_licenses
    find = lambda text: fitted.find(licenses.words_of(text.encode()))
    for family, texts in licenses.TEMPLATES.items():
        for t in texts:
            got = find(t)
            assert got and got[0] == family and got[2] >= licenses.MIN_SIMILARITY, (family, t, got)
    assert find("Licensed under the Apache License, Version 2.0 by us")[0] == "apache-2.0"
    for plain in ("the license of the work", "software and words of the people", "permission to go", "this work is of the kind we like"):
        got = find(plain)
        assert got is None or got[2] < licenses.MIN_SIMILARITY


def test_licenses_in_documents(spark):
    import __spark_entry__ as entry

    rows = [r for r in entry.queries()["op8_license_scan"](spark, SMALL).collect() if r["confirmed"]]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    want = collections.Counter()
    for i, text in texts.items():
        for line in text.split("\n"):
            if re.fullmatch(r"(Licensed|Released|This work is licensed) under .*", line):
                want[i, line] += 1
    got = collections.Counter((r["doc_id"], texts[r["doc_id"]][r["start"] : r["end"]]) for r in rows)
    assert got == want
