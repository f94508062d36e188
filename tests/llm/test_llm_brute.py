"""Each operator against a plain computation of the same, and the SQL of those that have any."""

import hashlib
import os
import random
import re
import sys
import zlib
from collections import Counter
from functools import cache

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from hourgrid.llm import (  # noqa: E402
    common, embedding_pairs, induced_sort, language, neighbours, packing, pseudo_likelihood, repeats, simhash,
)
from hourgrid.llm.common import components, dealt_join, heavy_keys  # noqa: E402
from hourgrid.llm.neighbours import nearest_neighbours  # noqa: E402
from hourgrid.llm.queries import ORACLES, QUERIES, WORDS  # noqa: E402

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    expected = sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall())
    assert sorted(tuple(r) for r in df.select(*columns).collect()) == expected and expected


def test_heavy_keys_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(common, "FEW", 10)
    monkeypatch.setattr(common, "HEAVY", 20)
    rows = spark.createDataFrame(
        [("hot" if i % 3 == 0 else f"k{i % 90}", i) for i in range(900)] + [("none", i) for i in range(50)],
        "key string, i long",
    )
    keyed = rows.filter("key <> 'none'").groupBy("key").agg(F.count("*").alias("n"), F.min("i").alias("least"))
    heavy = heavy_keys(rows.groupBy("key").agg(F.count("*").alias("n")), "key", "n")
    assert {r.key: r.parts for r in heavy.collect()} == {"hot": 7, "none": 2}  # 950 rows, 48 in a part
    met = dealt_join(rows, keyed, heavy, "key", F.xxhash64("i"))
    assert met.columns == ["key", "i", "n", "least"]
    expected = rows.join(keyed, "key").select("key", "i", "n", "least")
    assert sorted(met.collect()) == sorted(expected.collect()) and met.count() == 900
    assert heavy_keys(keyed.filter("false"), "key", "n").count() == 0


@pytest.mark.parametrize("name", ["op2_scan_secrets", "op7_dedup_lines"])
def test_query_equals_sql_with_keys_dealt(spark, monkeypatch, name):
    monkeypatch.setattr(common, "FEW", 2)
    test_query_equals_sql(spark, name)


def grouped(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    dice = random.Random(4)
    links = [(dice.randrange(300), dice.randrange(300)) for _ in range(220)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(60)]
    expected = grouped(links, {n for pair in links for n in pair if pair[0] != pair[1]})
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {n: r for n, r in expected.items()}
    a, b = (np.array(x) for x in zip(*links))
    nodes, roots = simhash.forest(a, b)
    assert {n: expected.get(n, n) for n in nodes.tolist()} == dict(zip(nodes.tolist(), roots.tolist()))


def test_fingerprints_by_vantage_points(spark, monkeypatch):
    """Many small leaves and blocks, dense groups, all pairs as the measure."""
    for name, value in (("LEAF", 64), ("BLOCK", 100), ("AT_ONCE", 1 << 10)):
        monkeypatch.setattr(simhash, name, value)
    dice = random.Random(1)
    prints = [dice.getrandbits(64) for _ in range(700)]
    for seed in prints[:20]:
        for _ in range(15):
            prints.append(prints[-1] ^ 1 << dice.randrange(64) if dice.random() < 0.5 else seed ^ 1 << dice.randrange(64))
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    links = [
        (a, b) for i, a in enumerate(prints) for b in prints[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3
    ]
    rows = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = [(r.u, r.v) for r in simhash.near_fingerprints(rows, 3).collect()]
    assert grouped(found, prints) == grouped(links, prints)


@cache
def vectors(n=900):
    random_ = np.random.default_rng(8)
    rows = random_.standard_normal((n, 24))
    rows[200:260] = rows[200] + 0.15 * random_.standard_normal((60, 24))
    rows[300:320] = rows[300]  # copies
    rows[400:440] *= 7
    return rows


# small cells; large cells dealt in parts; one cell, cut within its task
@pytest.mark.parametrize("part,least", [(100, 32), (100, 10_000), (65_536, 32)])
def test_vectors_by_brute_force(spark, monkeypatch, part, least):
    monkeypatch.setattr(embedding_pairs, "PART", part)
    monkeypatch.setattr(embedding_pairs, "LEAST", least)
    monkeypatch.setattr(embedding_pairs, "ROWS", 16)
    rows = vectors()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    units = rows / np.linalg.norm(rows, axis=1)[:, None]
    near = units @ units.T >= 0.9
    np.fill_diagonal(near, False)
    expected = grouped(list(zip(*map(list, np.nonzero(near)))), range(len(rows)))
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_pairs.link_vectors(df).collect()}
    assert found == {i: (int(near[i].sum()), expected[i], expected[i] == i) for i in range(len(rows))}

    answers = nearest_neighbours(df, df.filter("vec_id % 20 = 0")).collect()
    score = units @ units.T
    hits = 0
    for q in range(0, len(rows), 20):
        score[q, q] = -2
        best = np.lexsort((np.arange(len(rows)), -score[q].round(12)))[:5]
        own = sorted((r["rank"], r.vec_id, r.score) for r in answers if r.query_id == q)
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5]
        assert all(abs(s - score[q, v]) < 1e-12 for _, v, s in own)
        hits += len({v for _, v, _ in own} & set(best.tolist()))
    assert hits / (5 * len(range(0, len(rows), 20))) >= 0.9


@pytest.mark.parametrize("among", [True, False])
def test_cells_bring_pairs_in_reach_together_once(among):
    dice = np.random.default_rng(6)
    rows = np.concatenate([dice.standard_normal((300, 3)), np.full((40, 3), 0.25)])  # equal rows, too
    home, guests = np.arange(200), np.arange(200, 340)
    tree = embedding_pairs.grown(rows[:200], 0.3, 10)
    assert sum(node is None for node in tree) > 10
    met, at_home = Counter(), Counter()
    for cell, own, visits in embedding_pairs.cells(tree, rows, 0.3, home, guests, among):
        assert tree[cell] is None
        at_home.update(own.tolist())
        met.update((a, b) for a in own.tolist() for b in visits.tolist())
        if among:
            met.update((a, b) for a in own.tolist() for b in own.tolist() if a < b)
    assert at_home == Counter(home.tolist())
    pairs = Counter(tuple(sorted(pair)) for pair in met.elements())
    assert set(pairs.values()) == {1}
    close = (np.abs(rows[:, None] - rows[None]) <= 0.3).all(axis=2)
    for a in range(200):
        for b in range(a + 1, 340):
            if close[a, b] and (among or b >= 200):
                assert pairs[a, b] == 1
    assert among or all(b >= 200 for _, b in pairs)
    assert len(pairs) < 0.8 * (200 * 199 / 2 * among + 200 * 140)


def test_a_hub_is_dealt(spark, monkeypatch):
    monkeypatch.setattr(common, "FEW", 5)
    links = [(5000, i) for i in range(300)] + [(i, 9000 + i) for i in range(0, 300, 7)] + [(9500, 9600), (9600, 9700)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == grouped(links, {n for pair in links for n in pair})


def test_repeated_ids_do_not_share_a_shard(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 40)
    dice = np.random.default_rng(8)
    rows = [(i if i % 3 else 7, v.tolist()) for i, v in enumerate(dice.standard_normal((240, 6)))]
    rows += rows[:60]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest_neighbours(df, df.filter("vec_id = 1"), k=3).orderBy("rank").collect()
    units = {i: [] for i, _ in rows}
    for i, v in rows:
        units[i].append(np.array(v) / np.linalg.norm(v))
    best = sorted(((max(float(units[1][0] @ v) for v in own), i) for i, own in units.items() if i != 1), reverse=True)
    assert [(r.vec_id, r["rank"]) for r in found] == [(i, n + 1) for n, (_, i) in enumerate(best[:3])]


def test_rows_in_reach_are_visited():
    """Chances of cells and buckets against neighbours put at known distances."""
    dice = np.random.default_rng(12)
    made = neighbours.Tables(64, 2, 48, 1.0, 4)
    unit = dice.standard_normal(64)
    unit /= np.linalg.norm(unit)
    for reach in (0.4, 1.0):
        in_cell, in_bucket, visits = [], [], []
        for turn in range(150):
            turned = np.linalg.qr(dice.standard_normal((64, 64)))[0] @ unit
            aside = dice.standard_normal((20, 64))
            aside -= (aside @ turned)[:, None] * turned
            aside /= np.linalg.norm(aside, axis=1)[:, None]
            cosine = 1 - reach ** 2 / 2
            rows = cosine * turned + np.sqrt(1 - cosine ** 2) * aside
            cells = made.visited(turned, turn % 2, reach, 0.9)
            assert len(cells) == len(set(cells.tolist()))
            visits.append(len(cells))
            in_cell.append(np.isin(made.cells(rows, turn % 2), cells).mean())
            away = ((made.places(turned[None], turn % 2) - made.centres(rows, turn % 2)) ** 2).sum(axis=1)
            in_bucket.append((away <= made.radius(np.array([reach]), 0.75)[0]).mean())
        assert np.mean(in_cell) > 0.87 and 0.65 < np.mean(in_bucket) < 0.9
        assert np.mean(visits) < 4 ** 4 / 2


def test_neighbours_in_many_cells(spark, monkeypatch):
    """Cells of several lots and blocks, a third of all rows one vector, and the share visited."""
    monkeypatch.setattr(neighbours, "SHARD", 300)
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(common, "FEW", 100)
    dice = np.random.default_rng(13)
    rows = dice.standard_normal((3000, 64))
    rows[1::3] = rows[1]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    visited, whole = [], neighbours.best_of  # rows that queries visit, of all
    units = rows / np.linalg.norm(rows, axis=1)[:, None]
    answers = {}
    for r in nearest_neighbours(df, df.filter("vec_id % 50 = 0")).collect():
        answers.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in range(0, 3000, 50):
        score = units @ units[q]
        score[q] = -2
        best = np.lexsort((np.arange(3000), -score.round(12)))[:5].tolist()
        own = sorted(answers[q])
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5]
        assert all(abs(s - score[v]) < 1e-12 for _, v, s in own)
        if q % 3 == 1:  # copies: ties to the smaller id
            assert [v for _, v, _ in own] == best
        else:
            hits += len({v for _, v, _ in own} & set(best))
    assert hits / (5 * 40) >= 0.9
    made = neighbours.Tables(64, 2, neighbours.FUNCTIONS, neighbours.WIDTH, 0)
    alone, ids = np.delete(rows, np.arange(4, 3000, 3), axis=0), np.delete(np.arange(3000), np.arange(4, 3000, 3))
    asked = ids % 50 == 0
    for table in range(2):
        first = whole(alone, ids, alone[asked], ids[asked], np.full(asked.sum(), -2.0), 5, made, table, 128, 0.75)
        floor = np.array([np.sort(first[2][first[0] == q])[0] for q in range(asked.sum())])
        then = whole(alone, ids, alone[asked], ids[asked], floor, 5, made, table, None, 0.75)
        visited.append((first[3] + then[3]) / (asked.sum() * len(ids)))
    assert sum(visited) < 0.6


def test_segmentations_are_summed():
    """The forward algorithm against all segmentations, and the counts against their shares."""
    pieces = language.Pieces.__new__(language.Pieces)
    pieces.pieces = sorted(["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab"])
    pieces.longest = 3
    hashes = np.array([language._hash(np.array([[ord(c) for c in p]]))[0] for p in pieces.pieces])
    pieces.order = np.argsort(hashes)
    pieces.hashes = hashes[pieces.order]
    dice = np.random.default_rng(2)
    chances = np.vstack([dice.random((8, 2)), np.full((1, 2), 1e-7)])

    def ways(word):
        if not word:
            yield []
        for n in range(1, 4):
            if n <= len(word) and (word[:n] in pieces.pieces or n == 1):
                for rest in ways(word[n:]):
                    yield [word[:n], *rest]

    def chance(way, lang):
        return np.prod([chances[pieces.pieces.index(p) if p in pieces.pieces else 8, lang] for p in way])

    words = ["abab", "a", "abcab", "baab", "c"]
    scores = language.word_scores(words, pieces, chances)
    counts = language.expected_counts(words, np.array([1, 2, 3, 1, 1]), pieces, chances[:, :1])
    expected = dict.fromkeys(pieces.pieces, 0.0)
    for i, (word, times) in enumerate(zip(words, [1, 2, 3, 1, 1])):
        for lang in (0, 1):
            assert np.isclose(scores[i, lang], np.log(sum(chance(w, lang) for w in ways("▁" + word))))
        total = sum(chance(w, 0) for w in ways("▁" + word))
        for way in ways("▁" + word):
            for p in way:
                if p in expected:
                    expected[p] += times * chance(way, 0) / total
    assert np.allclose(counts, [expected[p] for p in pieces.pieces])


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op8_identify_language"](spark, "/root/testdata/sf0.01").join(docs, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_tokens_are_those_of_whole_texts():
    texts = [
        "The cat's tail, don't!  x́y\tÅ\nİstanbul ǅ 12ab <|endoftext|> a<|endoftext|>b <|ENDOFTEXT|>",
        "ΑΣ ΟΔΟΣ. tail   x\x1cy \x85z naïve é ́ 日本語テキスト 🙂🙂 'S 's 'll", "",
        "J\u030c H\u0331a T\u0308 Y\u030aB W\u030a", "PLAIN Words İ Σ ΣΣ K Å ẞ, Ǆ",
    ]
    tokens = packing.WordTokens(WORDS)
    whole = [packing.tokenizer_at(WORDS).encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in tokens.ids([t.encode() for t in texts])] == whole
    ids = np.arange(130, dtype="<u4").tobytes()
    assert [(p, s, n) for p, s, n, _ in packing.pieces_of(ids, 64)] == [(0, 0, 64), (1, 64, 64), (2, 128, 2)]
    assert packing.pieces_of(ids, 64)[1][3] == zlib.crc32(ids[256:512])


def test_sum_of_squares_places_where_the_sum_is_least():
    dice = random.Random(3)
    lengths = [dice.randint(1, 20) for _ in range(300)]
    bins, offsets = packing.sum_of_squares(np.array(lengths), 20)
    gaps = {}
    for length, chosen, offset in zip(lengths, bins.tolist(), offsets.tolist()):
        def total(b):
            after = {**gaps, b: gaps.get(b, 20) - length}
            n = [0] * 21
            for g in after.values():
                n[g] += 1
            return sum(x * x for x in n[1:])

        options = {b: total(b) for b in [*[b for b, g in gaps.items() if g >= length], max(gaps, default=-1) + 1]}
        assert options[chosen] == min(options.values()) and offset == 20 - gaps.get(chosen, 20)
        gaps[chosen] = gaps.get(chosen, 20) - length
    # from the longest to the shortest
    short = np.sort([dice.randint(1, 12) for _ in range(300)])[::-1]
    assert packing.sum_of_squares(short, 20)[0].max() + 1 <= 1.03 * short.sum() / 20 + 1


def test_placing_order():
    lengths = np.array([dice for dice in range(1, 101)] * 3)
    order = packing.placing_order(lengths, 100, 5)
    assert sorted(order.tolist()) == list(range(300)) and order.tolist() == packing.placing_order(lengths, 100, 5).tolist()
    placed = lengths[order]
    long = placed[placed * packing.SHORT >= 100]
    assert placed[:len(long)].tolist() == sorted(long, reverse=True)
    assert placed[len(long):].tolist() != sorted(placed[len(long):], reverse=True)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_pack_query_against_whole_texts(spark, folder):
    """Every row of ``op9_pack_documents`` made again from the tokenizer; sequences without
    gaps, and hardly more of them than all tokens need."""
    path = f"/root/testdata/{folder}"
    expected = {}
    for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect():
        ids = np.array([*packing.tokenizer_at(WORDS).encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start:start + 2048]
            expected[r.doc_id, piece] = (start, len(part), zlib.crc32(part.tobytes()))
    rows = QUERIES["op9_pack_documents"](spark, path).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected and len(rows) == len(expected)
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 2048
    bound = -(-sum(n for _, n, _ in expected.values()) // 2048)
    assert len(filled) <= 1.003 * bound + 5


def plain_fingerprint(text):
    """The bits of a text, made from its words one by one."""
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[\x20\x09-\x0D]+", lower) if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprints_of_the_query(spark):
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    prints = {i: plain_fingerprint(text) for i, text in texts}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    expected = grouped(links, prints)
    rows = QUERIES["op6_simhash_groups"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{p:016x}", expected[i]) for i, p in prints.items()
    }


def test_pseudo_likelihood_by_hand_and_slope():
    """Scores against plain sums over all classes and places; steps against differences."""
    dice = np.random.default_rng(5)
    shape = pseudo_likelihood.Shape()
    weights = {k: (0.3 * dice.standard_normal(s)).astype(np.float32) for k, s in shape.sizes.items()}
    text = dice.integers(0, shape.tokens, 9).astype(np.int32)
    near, token = pseudo_likelihood.windows([text[:5], text[5:5], text[5:]], shape.pad)
    pad = [shape.pad] * pseudo_likelihood.WINDOW
    assert token.tolist() == text.tolist()
    assert near[0].tolist() == [*pad, text[1], text[2]] and near[4].tolist() == [text[2], text[3], *pad]
    found = pseudo_likelihood.log_probabilities(weights, near, token)
    for i in range(len(token)):
        hidden = np.tanh(weights["bias"] + sum(weights["inputs"][s][near[i, s]] for s in range(near.shape[1])))
        kind, place = divmod(int(token[i]), shape.places)
        classes = np.exp(hidden @ weights["classes"] + weights["class_bias"])
        places = np.exp(hidden @ weights["places"][kind] + weights["place_bias"][kind])
        assert np.isclose(found[i], np.log(classes[kind] / classes.sum() * places[place] / places.sum()), atol=1e-5)
    learner = pseudo_likelihood.Learner(weights)
    before = found.sum()
    for _ in range(20):
        learner.step(near, token)
    assert pseudo_likelihood.log_probabilities(learner.weights, near, token).sum() > before


def test_every_word_is_learned_once():
    class Recorder(pseudo_likelihood.Learner):
        seen = ()

        def step(self, near, token):
            assert len(token) <= pseudo_likelihood.STEP
            self.seen = (*self.seen, *map(tuple, np.column_stack([near, token])))
            super().step(near, token)

    dice = random.Random(2)
    texts = [" ".join(f"w{dice.randrange(900)}" for _ in range(n)).encode() for n in (0, 1, 7000, 12, 0, 9000, 400)]
    shape = pseudo_likelihood.Shape()
    tokens = pseudo_likelihood.Words([b"w1", b"w2", b"w3"], shape).tokens(texts)
    near, token = pseudo_likelihood.windows(tokens, shape.pad)
    learner = Recorder(shape.first(np.ones(shape.tokens)))
    pseudo_likelihood.learn(learner, tokens, np.random.default_rng(0), shape.pad)
    assert sorted(learner.seen) == sorted(map(tuple, np.column_stack([near, token])))
    assert learner.words == 16413


def test_shards_hold_every_document_once_whatever_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "SHARD", 40)
    texts = [f"a{i} b{i % 7} c" * (1 + i % 3) for i in range(900)] + ["copy of a row"] * 700 + ["", None]
    rows = [(i if i < 900 else 7000, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    corpus = pseudo_likelihood.Corpus(pseudo_likelihood.word_counts(docs, "text"))
    found = []
    for n in (1, 5):
        waves = [
            pseudo_likelihood.shard_tokens(docs.repartition(n), corpus, wave, id="doc_id", text="text").collect()
            for wave in pseudo_likelihood.WAVES
        ]
        assert sum(map(len, waves)) == len(rows) and all(waves)
        found.append(sorted((r.shard, r.key) for wave in waves for r in wave))
    copies = {shard for shard, key in found[0] if sum(k == key for _, k in found[0]) > 100}
    assert len(copies) >= 700 / pseudo_likelihood.COPIES  # a very common row is dealt to several shards
    common = [key for _, key in found[0] if sum(k == key for _, k in found[0]) > 100][0]
    assert [x for x in found[0] if x[1] != common] == [x for x in found[1] if x[1] != common]


def plain_scores(rows, corpus, weights):
    """The scores of (id, text), word by word."""
    shape, words = corpus.shape, pseudo_likelihood.Words(corpus.frequent, corpus.shape)
    count, total, found = {}, {}, {}
    words = {w: int(words.token[words[w]]) for _, t in rows for w in (t or '').encode().lower().split()}
    for _, text in rows:
        for word in (text or "").encode().lower().split():
            count[word] = count.get(word, 0) + 1
            total[words[word]] = total.get(words[word], 0) + 1
    pad = [shape.pad] * pseudo_likelihood.WINDOW
    for i, text in rows:
        own = (text or "").encode().lower().split()
        padded = [*pad, *(words[word] for word in own), *pad]
        score = 0.0
        for at, word in enumerate(own):
            near = padded[at:at + 2] + padded[at + 3:at + 5]
            hidden = np.tanh(weights["bias"] + sum(weights["inputs"][s][near[s]] for s in range(4)))
            kind, place = divmod(words[word], shape.places)
            classes = hidden @ weights["classes"] + weights["class_bias"]
            places = hidden @ weights["places"][kind] + weights["place_bias"][kind]
            score += classes[kind] - np.log(np.exp(classes).sum()) + places[place] - np.log(np.exp(places).sum())
            score += np.log(count[word] / total[words[word]])
        found[i] = (len(own), score)
    return found


def test_scores_of_the_query_are_plain_sums(spark):
    """All of ``op4_score_texts``, with the network that its training gives."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {r.doc_id: r for r in QUERIES["op4_score_texts"](spark, SF_DIR).collect()}
    corpus = pseudo_likelihood.Corpus(pseudo_likelihood.word_counts(docs, "text"))
    weights = corpus.shape.unpacked(pseudo_likelihood.train(docs, corpus))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    for i, (n, score) in plain_scores(rows, corpus, weights).items():
        assert found[i].n_words == n and np.isclose(found[i].log_likelihood, score, rtol=1e-4, atol=1e-3)
        assert n == 0 and found[i].mean_log_likelihood is None or np.isclose(found[i].mean_log_likelihood * n, found[i].log_likelihood)


@pytest.fixture(scope="module")
def by_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, [
        {r.doc_id: r.log_likelihood for r in pseudo_likelihood.score_texts(docs.repartition(n)).collect()}
        for n in (1, 64)
    ]


def test_scores_do_not_depend_on_partitions(by_partitions):
    _, (one, many) = by_partitions
    assert one.keys() == many.keys() and all(np.isclose(one[i], many[i], rtol=1e-6) for i in one)


def test_scores_beat_plain_word_counts(by_partitions):
    docs, (scores, _) = by_partitions
    counts = Counter(w for r in docs.select("text").collect() for w in (r.text or "").encode().lower().split())
    words = sum(counts.values())
    plain = sum(n * np.log(n / words) for n in counts.values()) / words
    assert sum(scores.values()) / words > plain + 0.15


def test_tokens_grow_with_the_distinct_words():
    sizes = [pseudo_likelihood.Shape.of_words(n).tokens for n in (0, 10**4, 10**6, 10**8, 10**10)]
    assert sizes == sorted(sizes) and sizes[0] == 1 << pseudo_likelihood.BITS and sizes[-1] > 4 * sizes[2]


def test_scores_know_real_text_from_shuffled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter(F.length("text") > 1000)
    texts = [r.text for r in docs.select("text").orderBy("doc_id").collect()]
    dice = random.Random(0)
    mixed = [" ".join(dice.sample(t.split(), len(t.split()))) for t in texts]
    both = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-i - 1, t) for i, t in enumerate(mixed)], "doc_id long, text string")
    corpus = pseudo_likelihood.Corpus(pseudo_likelihood.word_counts(docs, "text"))
    weights = corpus.shape.unpacked(pseudo_likelihood.train(docs, corpus))
    words = pseudo_likelihood.Words(corpus.frequent, corpus.shape)
    score = {
        r.doc_id: pseudo_likelihood.log_probabilities(
            weights, *pseudo_likelihood.windows(words.tokens([r.text.encode()]), corpus.shape.pad)
        ).sum()
        for r in both.collect()
    }
    assert np.mean([score[i] > score[-i - 1] for i in range(len(texts))]) > 0.55


def test_scores_tell_words_of_a_token_apart(spark, monkeypatch):
    """By the words' counts: with them the probabilities of all words sum to 1. Whether their
    counts are known to all tasks or joined."""
    often = [f"f{i}" for i in range(pseudo_likelihood.Shape().frequent)]
    same = ["one-tail", "two-tail", "three-tail"]
    texts = [" ".join(often)] * 8 + [f"f1 f2 {w} f3 f4" for w, n in zip(same, (6, 2, 1)) for _ in range(n)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for near in (0, 16, 100):
        monkeypatch.setattr(pseudo_likelihood, "NEAR", near)
        rows = {r.doc_id: r for r in pseudo_likelihood.score_texts(docs).collect()}
        assert [rows[i].n_words for i in range(len(texts))] == [len((t or "").split()) for t in texts]
        first, second, third = (rows[i].log_likelihood for i in (8, 14, 16))
        assert np.isclose(first - second, np.log(3)) and np.isclose(second - third, np.log(2))
        assert np.isclose(rows[8].mean_log_likelihood * 5, first) and np.isclose(first, rows[9].log_likelihood)

    counts = pseudo_likelihood.word_counts(docs, "text")
    corpus = pseudo_likelihood.Corpus(counts)
    assert sorted(corpus.frequent) == sorted(w.encode() for w in often)
    shares = {bytes(r.word).decode(): round(np.exp(r.share) * 9) for r in corpus.shares(counts).collect() if r.share < 0}
    assert shares == dict(zip(same, (6, 2, 1)))


@pytest.mark.parametrize("held", [50, 10_000])
def test_induced_sorting(monkeypatch, held):
    """Windows and orders by induction, in memory and on disk, against a dictionary."""
    monkeypatch.setattr(induced_sort, "HELD", held)
    monkeypatch.setattr(induced_sort, "BATCH", 37)
    dice = random.Random(6)
    reach, size = 6, 10
    text = "".join(dice.choice("ab") for _ in range(700)) + "".join(dice.choice("abcd\0") for _ in range(200))
    data = text.encode()
    kind = induced_sort.context_kind(reach, size)
    rows = np.zeros(len(data), dtype=kind)
    for at in range(len(data)):
        before, after = min(at, reach), min(len(data) - at, size)
        rows["left"][at, :before] = np.frombuffer(data[at - before:at][::-1], np.uint8)
        rows["right"][at, :after] = np.frombuffer(data[at:at + after], np.uint8)
        rows["before"][at], rows["after"][at] = before, after
        rows["order"][at], rows["number"][at] = dice.randrange(20), at
    found = {
        (distance, n)
        for distance, numbers in induced_sort.earlier_windows([rows[a:a + 60] for a in range(0, len(rows), 60)], size)
        for n in numbers.tolist()
    }
    expected = set()
    for distance in range(reach + 1):
        least, windows = {}, {}
        for at in range(distance, len(data)):
            window = data[at - distance:at - distance + size]
            if len(window) == size:
                windows[at] = window
                least[window] = min(least.get(window, 99), int(rows["order"][at]))
        expected |= {(distance, at) for at, w in windows.items() if least[w] < rows["order"][at]}
    assert found == expected


def test_repeats_against_a_dictionary(spark):
    texts = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    first = {}
    for i in sorted(texts):
        for p in range(len(texts[i]) - 49):
            first.setdefault(texts[i][p:p + 50], i)
    for r in QUERIES["op10_remove_repeats"](spark, SF_DIR).collect():
        body = texts[r.doc_id]
        gone = bytearray(len(body))
        for p in range(len(body) - 49):
            if first[body[p:p + 50]] < r.doc_id:
                gone[p:p + 50] = b"\1" * 50
        assert r.n_removed == sum(gone) and r.n_bytes == len(body)


@pytest.mark.parametrize("chunk, often", [(1 << 23, 2_000_000), (1 << 14, 2_000_000), (1 << 14, 3), (1 << 16, 0)])
def test_repeats_whatever_is_common(spark, monkeypatch, chunk, often):
    """The same bytes go whether strings are sorted or named, in one chunk or in many."""
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    dice = random.Random(9)
    words = ["".join(dice.choice("abcdeé") for _ in range(dice.randint(2, 9))) for _ in range(400)]
    shared = [" ".join(dice.choices(words, k=k)) for k in (7, 9, 10, 14, 30)] + ["x" * 49, "y" * 50, "z" * 90]
    texts = {}
    for i in dice.sample(range(1000), 300):
        parts = [" ".join(dice.choices(words, k=dice.randint(0, 60)))]
        for _ in range(dice.choice([0, 0, 1, 3])):
            parts += [dice.choice(shared), " ".join(dice.choices(words, k=dice.randint(0, 12)))]
        texts[i] = " ".join(parts) if dice.random() < 0.9 or not texts else dice.choice(list(texts.values()))
    first, body = {}, {i: text.encode() for i, text in texts.items()}
    for i in sorted(body):
        for p in range(len(body[i]) - 49):
            first.setdefault(body[i][p:p + 50], i)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    rows = repeats.remove_repeats(docs, often=often).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = body[r.doc_id]
        gone = bytearray(len(own))
        for p in range(len(own) - 49):
            if first[own[p:p + 50]] < r.doc_id:
                gone[p:p + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(own, gone) if not g)
        runs = sum(1 for p, g in enumerate(gone) if g and (p == 0 or not gone[p - 1]))
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(own), sum(gone), runs)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("size", [21, 84, 130, 255])
def test_repeats_of_other_sizes(spark, size):
    dice = random.Random(size)
    passages = ["".join(dice.choices("abcde", k=k)) for k in (size - 1, size, size + 1, size + 40, 3 * size)]
    texts = {
        i: "".join("".join(dice.choices("abcde", k=dice.randint(0, 150))) + dice.choice(passages) for _ in range(3))
        for i in range(40)
    }
    first = {}
    for i, text in texts.items():
        for p in range(len(text) - size + 1):
            first.setdefault(text[p:p + size], i)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in repeats.remove_repeats(docs, size=size).collect():
        own = texts[r.doc_id]
        gone = bytearray(len(own))
        for p in range(len(own) - size + 1):
            if first[own[p:p + size]] < r.doc_id:
                gone[p:p + size] = b"\1" * size
        assert r.n_removed == sum(gone)
        assert r.kept_sha256 == hashlib.sha256(bytes(b for b, g in zip(own.encode(), gone) if not g)).hexdigest()


@pytest.mark.parametrize("size", [20, 256])
def test_repeats_refuse_sizes_that_do_not_work(spark, size):
    with pytest.raises(ValueError):
        repeats.remove_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"), size=size)
