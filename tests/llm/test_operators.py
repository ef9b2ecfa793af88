"""The operators against SQL, brute force and exact round trips, on small fixtures with
nulls, empty texts, repeated rows, empty tables and columns with clashing names."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from spanload.llm import bpe, chat, components, hnsw, lm, minhash, mixing, quality, queries, url_filter, vector_dedup, warc
from spanload.llm.common import read_table, words_of
from spanload.llm.q_text import VOCABULARY
from spanload.sources.tables import TABLES
from tests.conftest import SF001

queries.load_all()
DOC = "doc_id long, text string, lang string, source string, n_chars long, digest string, key string"


def docs_of(spark, texts):
    rows = [(i, t, "en", "s", 0, "x", "y") for i, t in texts]
    return spark.createDataFrame(rows, DOC)


def odd_texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdéü日") for _ in range(rng.randint(1, 4)))
    base = [[word() for _ in range(60)] for _ in range(4)]
    out = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "One"), (5, "two words")]
    for k in range(60):
        w = list(base[k % 4])
        for _ in range(k // 8):
            w[rng.randrange(len(w))] = word()
        out.append((10 + k, " ".join(w)))
    return [*out, (10, " ".join(base[0])), (None, "no id at all"), (99, "x" * 30000 + " end")]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF001)
    order = sorted(df.columns)
    res = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    want = [tuple(r[names.index(c)] for c in order) for r in res.fetchall()]
    assert sorted(names) == order
    assert sorted(map(repr, (tuple(r) for r in df.select(*order).collect()))) == sorted(map(repr, want))


def test_rows_of_every_query_on_empty_tables(spark, tmp_path):
    for t in ("documents", "labels", "pages", "conversations", "embeddings"):
        read_table(spark, SF001, t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    for name, q in queries.QUERIES.items():
        assert q(spark, str(tmp_path)).count() == 0, name


def test_url_rules_and_false_positives(spark):
    urls = [(1, "HTTP://WWW.A.com/x/?q"), (2, None), (3, "no scheme"), (4, "http://b.org"), (5, "http://www.b.org/p/"),
            (5, "http://www.b.org/p/"), (6, "http://b.org/p#f"), (7, "x://éA.net/P")]
    df = spark.createDataFrame([(i, u, "mine") for i, u in urls], "page_id long, url string, verdict string")
    got = sorted((tuple(r) for r in url_filter.filter_urls(
        df, df.where("page_id in (2, 5)"), [("com/", "allow"), ("a.com/x/", "block")], max_blocks=1).collect()), key=str)
    assert [(r[0], r[2], r[3], r[4], r[5]) for r in got] == [
        (1, "www.a.com", "/x/", "a.com/x/", "block"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "b.org", "", None, "allow"), (5, "www.b.org", "/p/", None, "block"), (5, "www.b.org", "/p/", None, "block"),
        (6, "b.org", "/p", None, "block"), (7, "éa.net", "/P", None, "allow")]


def test_bpe_equals_the_library_and_comes_back(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [*odd_texts(), (200, "a" * 50000), (201, "😀\x00\x1c\u2028 <|endoftext|>"), (202, "ab" * 20000)]
    ids = bpe.encode(docs_of(spark, texts), VOCABULARY, public_tokenizers.PATTERN)
    both = bpe.decode(ids, VOCABULARY, public_tokenizers.PATTERN).collect()
    assert len(both) == len(texts)
    for r in both:
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()


def closure(ids, pairs):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_on_paths_and_stars(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(200, 260)]
    pairs += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = {r.id: r.component for r in components.components(
        spark.createDataFrame([*pairs, (1, None), (5, 5)], "a long, b long")).collect()}
    ids = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == closure(ids, pairs)


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(spark, words, percent):
    texts = odd_texts()
    got = minhash.near_duplicates(docs_of(spark, texts), words, percent, side=12).collect()
    assert len(got) == len(texts)
    sets = {}
    for i, t in texts:
        w = words_of(t)
        sets[i] = {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    ids = [i for i in sets if i is not None]
    linked = [(a, b) for a in ids for b in ids if a < b and sets[a] and
              100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = closure(ids, linked)
    for r in got:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want.get(r.doc_id)), r
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)


def test_bitmap_bound_never_rules_out_a_link():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    for size in (1, 5, 200, 3000):
        a, b = base[:size], np.concatenate([base[: int(size * 0.93)], rng.integers(0, 1 << 63, max(1, size // 20), dtype=np.uint64)])
        both = len(np.intersect1d(a, b))
        found = minhash.forest(np.array([1, 2]), np.array([len(a), len(b)]),
                               np.stack([minhash.bitmap(x) for x in (a, b)]).view(np.uint64), np.zeros(2, int),
                               [np.unique(a), np.unique(b)], 85)
        assert len(found) == int(100 * both >= 85 * (len(a) + len(b) - both))


def test_a_tile_gives_a_forest_of_its_links():
    """Many near copies in components of their own: as many links as join them, not all pairs."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[k % 3:], rng.integers(0, 1 << 63, 2, dtype=np.uint64)])) for k in range(300)]
    sets += [rng.integers(0, 1 << 63, 300, dtype=np.uint64) for _ in range(50)]
    sets = [np.unique(s) for s in sets]
    n, bits = np.array([len(s) for s in sets]), np.stack([minhash.bitmap(s) for s in sets]).view(np.uint64)
    for own in (np.zeros(350, int), np.arange(350) % 2):
        links = minhash.forest(np.arange(350), n, bits, own, sets, 85)
        assert len(links) == 299 and {x for p in links for x in p} == set(range(300))


def test_rows_of_one_id_are_judged_by_their_own_texts(spark):
    rng = random.Random(8)
    a, b = (" ".join(str(rng.randrange(999)) for _ in range(80)) for _ in range(2))
    rows = [(7, a), (7, b), (3, b + " more"), (9, a.upper()), (8, a + " 1 2")]
    got = sorted(tuple(r) for r in minhash.near_duplicates(docs_of(spark, rows), 3, 85).select(
        "doc_id", "n_shingles", "component_id", "kept").collect())
    assert got == sorted([(7, 78, 7, True), (7, 78, 3, False), (3, 79, 3, True), (9, 78, 7, False), (8, 80, 7, False)])


def test_tiles_find_what_the_leads_leave_apart(spark):
    """No random leads, small tiles, the registered number of hashes: chains of copies of copies."""
    rng = random.Random(12)
    texts = []
    for c in range(3):
        w = [str(rng.randrange(10**6)) for _ in range(120)]
        for k in range(40):
            w = list(w)
            w[(7 * k) % 120] = f"x{c}-{k}"
            texts.append((100 * c + k, " ".join(w)))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(spark, texts), 3, 85, random_leads=0).collect()}
    assert got == {i: 100 * (i // 100) for i, _ in texts}


def vectors(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(6, 24))
    v = [(i, [float(x) for x in (centre[i % 6] + rng.normal(size=24) * (0.05 + 0.004 * i))]) for i in range(160)]
    v += [(200, v[0][1]), (201, v[0][1]), (202, None), (203, [0.0] * 24), (204, [float("nan")] + [1.0] * 23),
          (205, [None] + [1.0] * 23), (206, [1.0, 2.0]), (None, v[1][1]), (207, [float("inf")] + [0.0] * 23)]
    return v, spark.createDataFrame([(i, x, 1) for i, x in v], "vec_id long, embedding array<double>, id int")


def test_vector_links_against_all_pairs(spark):
    v, df = vectors(spark)
    ok = {i: np.array(x) for i, x in v if i is not None and i not in (202, 203, 204, 205, 206, 207)}
    pairs = [(a, b) for a in ok for b in ok if a < b and
             ok[a] @ ok[b] >= 0.9 * math.sqrt(ok[a] @ ok[a]) * math.sqrt(ok[b] @ ok[b])]
    links = Counter(x for p in pairs for x in p)
    want = closure([i for i, _ in v if i is not None], pairs)
    for dims, tile in ((8, 4096), (4, 16)):
        got = vector_dedup.near_vectors(df, 0.9, block_dims=dims, tile=tile).collect()
        assert len(got) == len(v)
        for r in got:
            assert (r.n_links, r.component_id) == (links.get(r.vec_id, 0), want.get(r.vec_id)), r


def test_vectors_of_very_many_lengths(spark):
    """Two near vectors of each of 1,200 lengths link, and no others."""
    rows = [(2 * d + k, [1.0] * d + [0.01 * k]) for d in range(2, 1202) for k in (0, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vector_dedup.near_vectors(df, 0.9).collect()
    assert len(got) == len(rows) and all((r.n_links, r.component_id) == (1, r.vec_id // 2 * 2) for r in got)


def test_nearest_against_all_pairs(spark):
    v, df = vectors(spark)
    ok = {i: np.array(x) for i, x in v if i is not None and i not in (202, 203, 204, 205, 206, 207)}
    got = {}
    for r in hnsw.nearest(df, df.where("vec_id % 20 = 0"), k=20, shard_rows=60).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = total = 0
    for q in [i for i in ok if i % 20 == 0]:
        best = sorted((-float(ok[q] @ ok[c]), c) for c in ok if c != q)[:20]
        found = [got[q][k] for k in sorted(got[q])]
        assert len(found) == 20 and all(abs(s - ok[q] @ ok[c]) < 1e-9 for c, s in found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        hits, total = hits + len({c for _, c in best} & {c for c, _ in found}), total + 20
    assert hits >= 0.95 * total


def test_warc_splits_of_any_size_and_revisits(spark, tmp_path):
    pages = [(1, "http://a/\r\nx", "p" * 1500), (2, None, "p" * 1500), (3, "u", None), (4, "u", "short"), (5, "u", "short"),
             (6, "v", "é" * 700), (9, "w", "é" * 700), (9, "w", "é" * 700), (None, "n", "q" * 2000), (7, "z", "\x1f\x8b" * 3000)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, payload string")
    manifest = warc.write(df, f"file://{tmp_path}/arc")
    best = {}
    for i, _, h in pages:
        if len((h or "").encode()) >= 1000 and i is not None:
            best[h] = max(i, best.get(h, i))
    want = sorted(repr((i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(),
                        "revisit" if best.get(h, i) != i else "response", best[h] if best.get(h, i) != i else None))
                  for i, _, h in pages)
    for split in (37, 1000, 1 << 22):
        read = warc.read(manifest, split)
        got = read.collect()
        ranges = sum(-(-r.bytes // split) for r in manifest.collect())
        assert read.rdd.getNumPartitions() == max(1, ranges)  # as many tasks as ranges, not one
        assert sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == want


def test_chat_masks_cover_the_speakers_words(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 2, "bob", None), (1, None, None, "?"),
            (1, 600, "ann", "late"), (2, 0, "system", "alone"), (None, 0, "cy", "é")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, speaker string")
    got = {(r.conv_id, r.segment, r.speaker): r for r in chat.rotate(df).collect()}
    assert set(got) == {(1, g, s) for g in (-1, 0, 2) for s in ("ann", "bob")} | {(None, 0, "cy")}
    r = got[(1, 0, "ann")]
    spans = [tuple(map(int, x.split("-"))) for x in r.mask.split(",")]
    assert [r.chat[a:b] for a, b in spans] == ["hi<|end|>"] and r.n_turns == 3 and r.n_chars == len(r.chat)
    assert "<|user:bob|>\n<|end|>" in r.chat and got[(1, -1, "ann")].mask == ""


def test_quality_keeps_clean_and_drops_junk(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        texts.append((i, " ".join(word() + ("%%%" if bad else "") for _ in range(40))))
        labels.append((i, 0 if bad else 1))
    df = docs_of(spark, [*texts, (None, None), (401, ""), (7, texts[7][1])])
    lab = spark.createDataFrame(labels[:300], "doc_id long, quality int")
    got = quality.classify(df, lab).collect()
    assert len(got) == 403
    held = [r for r in got if r.doc_id is not None and 300 <= r.doc_id < 400]
    assert all(r.kept == (r.doc_id % 4 != 0) for r in held)
    assert all(r.kept for r in quality.classify(df, lab.limit(0)).collect())


def test_site_shares_shrink_to_their_host(spark):
    rows = [("h", "big", 1.0, 1.0)] * 90 + [("h", "big", 1.0, 0.0)] * 10 + [("h", "one", 1.0, 0.0), ("j", "p", 1.0, 0.0)] * 1
    got = {(r.host, r.path): r.share for r in quality.site_shares(
        spark.createDataFrame(rows, "host string, path string, weight double, good double")).collect()}
    assert abs(got[("h", "big")] - 0.9) < 0.05 and got[("j", "p")] < got[("h", "one")] < got[("h", "big")]


def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(3)
    rows = [([float(x) for x in rng.dirichlet([3 * (k == i % 3) + 0.1 for k in range(3)])], int(rng.integers(0, 500)))
            for i in range(600)]
    table = spark.createDataFrame(rows, "p array<double>, tokens long")
    fitted, _ = mixing.fit_rates(table, [0.6, 0.3, 0.1], close=1e-3)
    p, t, r = (np.array(x) for x in zip(*[(r.p, r.tokens, r.rate) for r in fitted.collect()], strict=True))
    assert (r >= 0).all() and np.abs((r * t) @ p / t.sum() - [0.6, 0.3, 0.1]).max() < 2e-3


def plain_rates(p, t, goals, stay, floor):
    """The same least squares, solved to the end in numpy."""
    w, base = t / t.sum(), (t / t.sum()) @ p
    r = np.ones(len(p))
    for _ in range(20000):
        slope = p @ ((r * w) @ p / base - np.array(goals) / base) + stay * (r - 1)
        r = np.maximum(floor, r - slope / (1 + stay))
    return r


@pytest.mark.parametrize("goals, whole", [([0.5, 0.3, 0.2], None), ([0.3, 0.2, 0.5], 0)])
def test_rates_equal_a_plain_solver(spark, goals, whole):
    rng = np.random.default_rng(6)
    p = rng.dirichlet([0.4, 0.4, 0.4], 300)
    t = rng.integers(1, 400, 300)
    table = spark.createDataFrame([([float(x) for x in q], int(n)) for q, n in zip(p, t, strict=True)], "p array<double>, tokens long")
    fitted, shares = mixing.fit_rates(table, goals, 0.05, whole, close=0.0, still=1e-7)
    got = {tuple(x.p): x.rate for x in fitted.collect()}
    base = (t / t.sum()) @ p
    times = 1.0 if whole is None else max(1.0, base[whole] / goals[whole])
    want = plain_rates(p, t, [g * times for g in goals], 0.05, np.where(p[:, 0] > 0.5, 1.0, 0.0) if whole == 0 else 0.0)
    assert max(abs(got[tuple(float(x) for x in q)] - r) for q, r in zip(p, want, strict=True)) < 1e-3
    assert np.abs(np.array(shares) - (want * t) @ p / (want * t).sum()).max() < 1e-5


@pytest.mark.parametrize("rare", [2, 50])
def test_a_domain_is_kept_whole(spark, rare):
    """With more or fewer toxic tokens than the target's 5 %, no good document has a rate below 1,
    even with one whose posterior is doubtful, and none is taken without end."""
    rows = [([0.999, 0.001] if i % rare else [0.001, 0.999], 100) for i in range(500)] + [([0.500001, 0.499999], 100)]
    fitted, shares = mixing.fit_rates(spark.createDataFrame(rows, "p array<double>, tokens long"), [0.95, 0.05], whole=0)
    p, r = (np.array(x) for x in zip(*[(x.p, x.rate) for x in fitted.collect()], strict=True))
    assert r[p[:, 0] > 0.5].min() >= 1 and r.max() < 10
    assert np.abs(r @ p / r.sum() - [0.95, 0.05]).max() < 2e-3


def test_targets_that_cannot_be_met_are_reported(spark):
    table = spark.createDataFrame([([0.5, 0.5], 10), ([0.6, 0.4], 10)], "p array<double>, tokens long")
    with pytest.warns(UserWarning, match="can't be met"):
        _, shares = mixing.fit_rates(table, [0.05, 0.95], still=1e-3)
    assert 0.5 <= shares[0] < 0.56
    with pytest.raises(RuntimeError, match="in 2 steps"):
        mixing.fit_rates(table, [0.05, 0.95], most_steps=2)


def test_scores_add_up_and_the_base_is_exact(spark):
    texts = [*odd_texts(), (300, " ".join("the of and to in".split() * 40))]
    df = docs_of(spark, texts)
    got = lm.score_documents(df, VOCABULARY, public_tokenizers.PATTERN).collect()
    assert len(got) == len(texts)
    split = [(i, words_of(t) + [b""]) for i, t in texts]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter(w for i, ws in split if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), held(i), len(ws), sum(counts[w] > 0 for w in ws), n,
                   round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in split)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_a_token_is_scored_once_with_its_own_past():
    """Window by window, the scores are those of the positions taken one at a time."""
    rng = np.random.default_rng(0)
    kind = np.arange(50) % lm.CLASSES
    transitions = rng.integers(0, 50, (lm.CLASSES + 1, lm.CLASSES + 1)).astype(float)
    w = lm.start_weights(transitions)
    s = lm.Scorer(w, kind, np.log(np.full(50, 0.5)), {}, VOCABULARY, public_tokenizers.PATTERN)
    lengths = np.array([1, 15, 16, 17, 40])
    ids = rng.integers(0, 50, lengths.sum())
    got = s.model(ids, lengths)
    at = 0
    for g, m in zip(got, lengths, strict=True):
        c = kind[ids[at: at + m]]
        at += m
        seen = np.concatenate([np.full(lm.WINDOW - lm.STRIDE, lm.PAD), [lm.BEGIN], c[:-1], np.full(lm.STRIDE, lm.PAD)])
        total = 0.0
        for t in range(m):
            window = seen[t // lm.STRIDE * lm.STRIDE:][: lm.WINDOW][None].copy()
            logits, _ = lm.attend(w, window)
            x = logits[t % lm.STRIDE].astype(float)
            total += x[c[t]] - math.log(np.exp(x).sum()) + math.log(0.5)
        assert abs(g - total / math.log(10)) < 1e-3


def test_lm_shares_sum_to_one():
    """Whatever stands before, the probabilities of all next subwords make 1."""
    rng = np.random.default_rng(5)
    initial = np.arange(50) < 20
    w = lm.start_weights(rng.integers(0, 50, (lm.CLASSES + 1, lm.CLASSES + 1)).astype(float))
    w["rows"][:, 50:] = -1e4  # one id in each of 50 classes, and no others
    w["out"] *= 30
    tree = lm.Beginnings(50, [[5, 25], [5, 25, 30], [5, 31], [7], [5, 25, 30, 30]], [9, 4, 3, 2, 1])
    s = lm.Scorer(w, np.arange(50), np.zeros(50), {}, VOCABULARY, public_tokenizers.PATTERN, initial, tree)

    def score(texts):
        ids, own, model = [], [], []
        for words in texts:
            flat = [i for word in words for i in word]
            shares = [tree.shares(word) for word in words]
            ids += flat
            own += [1.0, *(x for a, _ in shares for x in a)][: len(flat)]
            model += [0.0, *(x for _, b in shares for x in b)][: len(flat)]
        sizes = np.array([sum(map(len, words)) for words in texts])
        return 10 ** s.model(np.array(ids), sizes, (np.array(own), np.array(model)))

    assert score([[[i]] for i in range(20)]).sum() == pytest.approx(1, abs=1e-4)
    for word in ([5], [5, 25], [5, 25, 30], [5, 40], [9], [7]):
        after = score([[[5, 31], word, [i]] if initial[i] else [[5, 31], [*word, i]] for i in range(50)])
        assert after.sum() / score([[[5, 31], word]])[0] == pytest.approx(1, abs=1e-4)



def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in lm.start_weights(rng.random((lm.CLASSES + 1, lm.CLASSES + 1)) * 9).items()}
    seen = rng.integers(0, lm.CLASSES, (3, lm.WINDOW))
    goal = rng.integers(0, lm.CLASSES, (3, lm.STRIDE))

    def loss():
        return -lm.log_softmax_at(lm.attend(w, seen)[0], goal.reshape(-1)).mean()

    grad = lm.gradients(w, seen, goal)
    for name in w:
        flat, g = w[name].reshape(-1), grad[name].reshape(-1)
        i = int(np.abs(g).argmax())
        old = flat[i]
        flat[i] = old + 1e-5
        up = loss()
        flat[i] = old - 1e-5
        down = loss()
        flat[i] = old
        assert abs((up - down) / 2e-5 - g[i]) < 1e-4, name


def test_training_takes_every_place_as_a_target_once(monkeypatch):
    """Inputs stand right before their targets, for texts of any length."""
    monkeypatch.setattr(lm, "BLOCK", 2)
    kind = np.random.default_rng(4).integers(0, lm.CLASSES, 5000)
    for n in (1, 15, 16, 17, 32, 33, 1000):
        ids = list(range(n))
        blocks = list(lm.train_windows(ids, kind))
        seen, goal = (np.concatenate(x) for x in zip(*blocks, strict=True))
        assert max(len(x) for x, _ in blocks) <= 2 and seen.shape == (len(goal), lm.WINDOW)
        assert list(goal[goal >= 0]) == list(kind[ids]) and (goal.reshape(-1)[n:] == -1).all()
        inputs = seen[:, lm.WINDOW - lm.STRIDE:].reshape(-1)[:n]
        assert list(inputs) == [lm.BEGIN, *kind[ids][:-1]]
        for before, window in zip(seen, seen[1:], strict=False):  # context: the inputs of the window before
            assert list(window[: lm.WINDOW - lm.STRIDE]) == list(before[lm.WINDOW - lm.STRIDE:])


def test_the_end_of_a_long_text_is_a_target():
    """Of the last window, which holds nothing after it."""
    encoding, end = lm.tokenizer(VOCABULARY, public_tokenizers.PATTERN)
    kind = np.zeros(end + 1, np.int64)
    kind[end] = 7
    for n in (1, 30, 500):
        ids = [i for word in [b"word"] * n + [lm.END] for i in lm.subwords(word, encoding, end)]
        goal = np.concatenate([y for _, y in lm.train_windows(ids, kind)]).reshape(-1)
        assert list(np.flatnonzero(goal == 7)) == [len(ids) - 1]


def test_training_teaches_the_end_of_long_texts(spark):
    """Steps over long texts raise the end's probability where it stands, from weights that don't know it."""
    encoding, end = lm.tokenizer(VOCABULARY, public_tokenizers.PATTERN)
    kind = np.zeros(end + 1, np.int64)
    kind[end], kind[lm.subwords(b"stop", encoding, end)] = 7, 5
    text = " ".join(["word"] * 60 + ["stop"])
    docs = spark.createDataFrame([(i, text) for i in range(64)], "doc long, text string")
    start = lm.start_weights(np.ones((lm.CLASSES + 1, lm.CLASSES + 1)))
    after = lm.train_round(docs, start, kind, VOCABULARY, public_tokenizers.PATTERN, 0.02)
    seen = np.concatenate([np.zeros(lm.WINDOW - 1, np.int64), [5]])[None]
    last = [lm.log_softmax_at(lm.attend(w, seen)[0][-1:], np.array([7]))[0] for w in (start, after)]
    assert last[1] > last[0]


def test_shares_of_all_words_are_joined(spark, monkeypatch):
    """Those of a tree of all training words; words that weren't trained on meet it as far as it goes."""
    seen = ["the", "then", "thenceforth", "internationalization", "internationalized", "a", "zzzqxv", "zzzq", "é" * 30]
    counted = [(w.encode(), 3 * i + 1) for i, w in enumerate(seen)]
    other = [w.encode() for w in ("internationalism", "zzzqxvv", "qqqqjjj", "thence")]
    words = spark.createDataFrame([*counted, *((w, 0) for w in other), (lm.END, 5)], "word binary, n long")
    encoding, end = lm.tokenizer(VOCABULARY, public_tokenizers.PATTERN)
    ids = {w: lm.subwords(w, encoding, end) for w in [lm.END, *(w for w, _ in counted), *other]}
    tree = lm.Beginnings(end + 1, [*(ids[w] for w, _ in counted), [end]], [*(n for _, n in counted), 5])
    counted = lm.stage(lm.with_ids(words, VOCABULARY, public_tokenizers.PATTERN), "ids")
    for most in (1, 4, 1 << 17):  # subwords a range: many beginnings lie in several
        monkeypatch.setattr(lm, "RANGE", most)
        got = lm.with_shares(counted, end + 1).collect()
        assert len(got) == len(ids)
        for r in got:
            assert (list(r.own), list(r.model)) == tree.shares(ids[bytes(r.word)]), r


def test_scores_do_not_depend_on_the_head(spark, monkeypatch):
    """The commonest words are only held for speed: with none of them, all is joined."""
    texts = [*odd_texts(), (300, " ".join("the of and to in internationalization".split() * 40)), (301, "x" * 70 + " ab")]
    df = docs_of(spark, texts)
    run = lambda: sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score)
                         for r in lm.score_documents(df, VOCABULARY, public_tokenizers.PATTERN).collect())
    monkeypatch.setattr(lm, "train_round", lambda docs, weights, *rest: weights)
    whole = run()
    monkeypatch.setattr(lm, "HEAD_WORDS", 0)
    for a, b in zip(whole, run(), strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-5, abs=1e-5)


def test_pipeline_compares_rows_not_ids(spark):
    """An id with two texts, wholly repeated rows, rows without an id."""
    text = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abcd"}
    rows = [(1, text["a"]), (2, text["a"]), (2, text["b"]), (3, text["c"]), (3, text["c"]),
            (None, text["c"]), (None, text["d"]), (None, text["d"]), (4, None), (4, None), (5, "")]
    got = corpus_pipeline.unique(spark, docs_of(spark, rows), SF001)
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted(
        (str(i), t) for i, t in [(1, text["a"]), (2, text["b"]), (3, text["c"]), (None, text["d"]), (4, None), (5, "")])


def test_pipeline_stages_take_effect(spark):
    docs = read_table(spark, SF001, "documents")
    kept = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        before, kept = kept.count(), corpus_pipeline.stage(step(spark, kept, SF001), name)
        assert kept.columns == docs.columns and 0 < kept.count()
        if name != "mixing":
            assert kept.count() < before
    out = corpus_pipeline.STAGES[-1][1](spark, kept, SF001)
    assert out.count() == kept.count() and out.where("not exact").isEmpty()


def test_a_group_of_near_copies_takes_about_a_comparison_a_node(spark, monkeypatch):
    pairs, own = [], minhash.confirm
    monkeypatch.setattr(minhash, "confirm", lambda p, *a: pairs.append(p.count()) or own(p, *a))
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join([*base[:i % 140], f"x{i}", *base[i % 140 + 1:]])) for i in range(200)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85).collect()
    assert len(found) == 200 and {r["component_id"] for r in found} == {0}
    assert sum(pairs) <= 2 * 200, pairs
