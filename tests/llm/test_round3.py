"""Repair, phrases and toxicity against brute force, with nulls, empty and very long texts, ties,
repeated rows, empty tables and columns with clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spanload.llm import bpe, phrases, repair, toxicity, url_filter
from spanload.llm.common import read_table
from spanload.llm.q_text import VOCABULARY
from tests.conftest import SF001

BLANK = " \t\n\x0b\x0c\r"
CONV = "conv_id long, turn long, role string, text string, key string, n long, conv string"


def plain_repair(rows):
    """The contract row by row: least (cost, audit) for each grammar state, in plain tuples."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or " ", (r[2] or " ")[:64].encode(),
                                       hashlib.md5((r[2] or " ").encode()).hexdigest()))
    turns = sorted({t for t, _, _ in rows if t is not None})
    out = {"gaps": turns[-1] - turns[0] + 1 - len(turns) if turns else 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    best, seen, before = {"": (0, "", [])}, set(), None
    put = lambda d, q, way: d.__setitem__(q, min(d.get(q, way), way))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(ways):
        ways = dict(ways)
        for _ in range(3):
            for q, (c, a, t) in list(ways.items()):
                for x in "ua":
                    if (q, x) in step:
                        put(ways, step[q, x], (c + 2, a + "I", [*t, names[x] + ":"]))
        return ways

    for _, role, text in rows:
        role, text = role or " ", text or " "
        if before is not None and before + role[:1] not in ("su", "ua", "au"):
            out["illegal"] += 1
        before = role[:1]
        bare = text.rstrip(BLANK)
        gone = cut = False
        if not bare:
            out["blank"] += 1
            gone = True
        elif (role, text) in seen:
            out["duplicate"] += 1
            gone = True
        elif bare[-1] not in ".!?":
            out["truncated"] += 1
            cut = True
        seen.add((role, text))
        new = {}
        for q, (c, a, t) in best.items():
            put(new, q, (c + 3, a + "D", t))
        if not gone:
            for q, (c, a, t) in inserted(best).items():
                if (q, role[0]) in step:
                    put(new, step[q, role[0]], (c + cut, a + "K", [*t, f"{role}:{text}"]))
                for x in "ua":
                    if (q, x) in step:
                        put(new, step[q, x], (c + 2 + cut, a + "R", [*t, f"{names[x]}:{text}"]))
        best = new
    ends = inserted(best)
    cost, audit, lines = min(ends[q] for q in ("", "a") if q in ends)
    return out | {"cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def dialogues():
    rng = random.Random(5)
    texts = ["Yes.", "No!", "Why?", "so then", "", None, " \t", "é.\n", "long " * 300 + ".", "x" * 70 + "1.", "x" * 70 + "2."]
    roles = ["user", "assistant", "system", None, "umpire", "tool", "user", "assistant"]
    rows = []
    for conv in [None, *range(40)]:
        for turn in range(rng.randrange(1, 12)):
            turn = rng.choice([turn, turn, turn, None, turn // 2])
            row = (conv, turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"t{rng.randrange(99)}.")
            rows += [row] * rng.choice([1, 1, 1, 2, 5])
    rows += [(99, t, ("user", "assistant", "tool")[t % 3 if t % 7 else 2], f"{t}" + ".!x "[t % 4]) for t in range(700)]
    rows += [(98, 1, "user", "again and again.")] * 900
    return rows


@pytest.mark.parametrize("block, fan, split", [(256, 256, False), (2, 2, False), (3, 2, True)])
def test_repair_equals_the_plain_way(spark, block, fan, split):
    rows = dialogues()
    df = spark.createDataFrame([(*r, "k", 1, "c") for r in rows], CONV)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, str(not split).lower())
    try:
        got = {r["conv_id"]: r.asDict() for r in repair.report(repair.repair(df, block=block, fan=fan)).collect()}
    finally:
        spark.conf.set(coalesce, "true")
    own = defaultdict(list)
    for conv, *row in rows:
        own[conv].append(row)
    assert got.keys() == own.keys()
    for conv, r in own.items():
        assert got[conv] == plain_repair(r) | {"conv_id": conv}, conv


def test_repaired_turns_are_well_formed(spark):
    df = spark.createDataFrame([(*r, "k", 1, "c") for r in dialogues()], CONV)
    pieces = repair.repair(df, block=5, fan=2).collect()
    own = defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p["key"], p["pid"], p["seq"])):
        own[p["key"]] += [e["role"][0] for e in p["edits"] if e["edit"] != "D"]
    assert len(own) == 43 and all(re.fullmatch("(s?(ua)+)?", "".join(r)) for r in own.values())


def test_damage(spark):
    rows = [(c, t, r, "Hm. Is it?") for c in [*range(60), None] for t in [0, None] for r in ("assistant", None)]
    df = spark.createDataFrame([(*r, "k", 1, "c") for r in rows], CONV)
    want = Counter()
    for c, t, r, x in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r = "user" if fault == 4 else " " if r is None else r
        x = {1: "", 2: "Hm Is it"}.get(fault, x)
        want.update([(c, t, r, x)] * {0: 0, 3: 2}.get(fault, 1))
    assert Counter(tuple(r) for r in repair.damage(df).collect()) == want


def plain_phrases(docs, least, top=2000):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i: i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    found = defaultdict(list)
    for p, a in f.items():
        if a >= least and len(p) > 2:
            lang, w = p[0], p[1:]
            score, _, left, right = min(
                (2000000 * a // (f[lang, *w[:k]] + f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w)))
            found[lang].append((-score, -a, " ".join(w).encode(), left, right, w))
    out = []
    for lang, rows in found.items():
        inside = defaultdict(int)
        for _, a, _, _, _, w in rows:
            for k in range(2, len(w)):
                for i in range(len(w) - k + 1):
                    inside[w[i: i + k]] = max(inside[w[i: i + k]], -a)
        kept = sorted(r for r in rows if 100 * inside[r[5]] < 80 * -r[1])[:top]
        out += [(lang, i + 1, r[2].decode(), -r[1], r[3], r[4], n[lang], -r[0]) for i, r in enumerate(kept)]
    return sorted(out)


def phrase_docs():
    rng = random.Random(9)
    words = ["the", "of", "The", "cat", "sat", "é", "日", "x\x1cy", "OF", "a-b", "un", "deux"]
    docs = [(None, None), ("en", ""), ("en", " \t.,;"), (None, "cat sat. " * 60), ("fr", "un deux " * 400)]
    for _ in range(150):
        docs.append((rng.choice(["en", "en", "fr", None]),
                     "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", "\n", "\x0b", "? "][: rng.choice([1, 7])]) for _ in range(40))))
    docs.append(("en", " ".join(rng.choice(words[:5]) for _ in range(40000))))  # longer than a span
    return docs + docs[10:20] * 5


@pytest.mark.parametrize("budget", [1 << 20, 4])
def test_phrases_equal_brute_force(spark, budget, monkeypatch):
    docs = phrase_docs()
    df = spark.createDataFrame([(t, x, 1, "p", 2) for x, t in docs], "text string, lang string, n long, phrase string, words long").repartition(3)
    own, split = phrases._bitmap, []

    def watched(rows, places):
        out = own(rows, places)
        if places is phrases._hash_bits:
            split.append(int(np.bitwise_count(out).sum()))
        return out

    monkeypatch.setattr(phrases, "_bitmap", watched)
    if budget < 100:  # prefixes are split down to full depth
        monkeypatch.setattr(phrases, "LEAST_ROWS", 1)
        monkeypatch.setattr(phrases, "SPLIT", 4)
        monkeypatch.setattr(phrases, "SAMPLED", 1.0)
    for top in (2000, 7):
        got = sorted(tuple(r) for r in phrases.collocations(df, least=12, top=top, budget=budget).collect())
        assert got == plain_phrases(docs, 12, top)
    assert all(n > 500 for n in split) if budget < 100 else split == [0, 0]


def toxic_docs(n=700):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abdegilmnorstu") for _ in range(rng.randint(2, 7)))
    stems = {"en": "zorvak", "fr": "quixé"}
    rows = []
    for i in range(n):
        lang, bad = rng.choice(["en", "fr"]), rng.random() < 0.4
        w = [word() for _ in range(rng.randint(20, 80))]
        if bad:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), stems[lang] + rng.choice(["", "e", "ly", "s,"]))
        rows.append((i, " ".join(w), lang, int(bad)))
    return rows


def test_toxicity_of_held_out_documents(spark):
    rows = toxic_docs()
    docs = spark.createDataFrame([(i, t, x, "s", -1, 9.0) for i, t, x, _ in rows] + [(None, None, None, "s", 1, 0.5), (5000, "", "de", "s", 1, 0.5)]
                                 + [(3, rows[3][1], "en", "s", 0, 0.1)], "doc_id long, text string, lang string, source string, toxic int, score double")
    labels = spark.createDataFrame([(i, y, "x") for i, _, _, y in rows] + [(None, 1, "x"), (1, None, "x"), (2, 7, "x")],
                                   "doc_id long, toxic int, text string")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = toxicity.classify(docs, labels, held).collect()
    assert len(got) == len(rows) + 3
    truth = {i: y for i, _, _, y in rows}
    out = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert {r["doc_id"] for r in out} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in out]) >= 0.95
    assert np.mean([r["flagged"] == bool(truth[r["doc_id"]]) for r in out]) >= 0.95
    # held-out labels, languages and ids have no say
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {(r["doc_id"], r["score"]) for r in toxicity.classify(docs, turned, held).collect()}
    assert again == {(r["doc_id"], r["score"]) for r in got}


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [tuple(r)[:4] for r in toxicity.classify(docs, none, F.lit(False)).collect()] == [(1, False, 0.0, 0)]
    assert toxicity.classify(docs.limit(0), none, F.lit(False)).count() == 0


def test_scores_do_not_depend_on_spans_or_company(monkeypatch):
    net = toxicity.Network(3)
    texts = [" ".join(f"w{i * k % 97}" for i in range(k * 130)) for k in range(6)] + [None]
    alone = [toxicity.Scorer(net).scores([t])[0] for t in texts]
    assert np.allclose(toxicity.Scorer(net).scores(texts), alone, atol=1e-6)
    monkeypatch.setattr(toxicity, "REMEMBERED", 20)
    assert np.allclose(toxicity.Scorer(net).scores(texts), alone, atol=1e-6)


def test_the_gradient_falls_along_training():
    rows = toxic_docs(300)
    toxic = np.array([y for *_, y in rows])
    net = toxicity.train([t for _, t, _, _ in rows], toxic)
    p = toxicity.Scorer(net).scores([t for _, t, _, _ in rows])
    assert -np.mean(np.log(np.where(toxic == 1, p, 1 - p))) < 0.1


def test_columns_named_as_the_operators_own(spark):
    names = ["_text", "_ids", "_b", "_key", "_host", "_path", "_rule", "_maybe", "_hit", "_w0", "_c0"]
    ddl = "doc_id long, text string, url string, " + ", ".join(f"{n} string" for n in names)
    rows = [(1, "Hello  World", "http://a.com/x", *names), (2, None, None, *names)]
    df = spark.createDataFrame(rows, ddl)
    both = bpe.decode(bpe.encode(df, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY, public_tokenizers.PATTERN)
    got = sorted(both.collect(), key=lambda r: r["doc_id"])
    assert [bytes(r["decoded"]) for r in got] == [b"Hello  World", b""] and [r[n] for r in got for n in names] == names * 2
    found = sorted(url_filter.filter_urls(df, df.where("doc_id = 1").select("url"), []).collect(), key=lambda r: r["doc_id"])
    assert [r["verdict"] for r in found] == ["block", "allow"] and [r[n] for r in found for n in names] == names * 2


def test_long_matches_are_encoded_and_not_kept():
    vocabulary = bpe.load_vocabulary(VOCABULARY, public_tokenizers.PATTERN)
    texts = ["a b " + "ab" * 400 + " c", "", "x" * 300 + " b", "b " + "ab" * 400]
    flat, counts = vocabulary.encode(texts)
    again, same = vocabulary.encode(texts)
    assert (flat == again).all() and (counts == same).all() and max(map(len, vocabulary.place)) <= bpe.CACHED_CHARS
    import pyarrow as pa
    ends = np.concatenate([[0], np.cumsum(counts)])
    assert vocabulary.decode(pa.array(flat), ends).to_pylist() == [t.encode() for t in texts]


def test_the_pipeline_on_empty_tables(spark, tmp_path):
    for t in ("documents", "labels"):
        read_table(spark, SF001, t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
