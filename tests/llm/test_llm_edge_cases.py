"""Every operator on nulls, empty and long texts, repeated rows, empty tables and extra columns."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest

from stratiform.llm.chat import rotate
from stratiform.llm.decontam import contaminated
from stratiform.llm.embdup import near_duplicate_vectors
from stratiform.llm.licenses import scan_licenses
from stratiform.llm.minhash import near_duplicates
from stratiform.llm.packing import pack_documents
from stratiform.llm.quality import score_quality
from stratiform.llm.tokencount import token_counts
from stratiform.llm.toxicity import score_toxicity
from stratiform.llm.warc import capture_histories, write_archives

LONG = "alpha beta gamma delta " * 5000
TEXTS = [(1, "Released under the MIT License. Some words follow here"), (2, None), (3, ""), (4, " \t\n "), (None, "no id at all"),
         (5, LONG), (6, "one two"), (6, "one two"), (7, "x" * 3000), (8, "naïve 漢字 \x00 <|endoftext|> <s> ▁ emoji 😀")]
# columns whose names the operators use themselves
SCHEMA = "doc_id bigint, text string, lang string, n int, words string, at int, seed string, g string, rep string, key string"


def docs(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, "en", 0, "w", 1, "s", "g", "r", "k") for i, t in rows], SCHEMA)


def json_ids(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.path("byte_bpe_50k.json")).encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("rows", [TEXTS, []])
def test_packing_covers_every_id_once(spark, rows):
    out = pack_documents(docs(spark, rows), P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    expected = sorted(zlib.crc32(np.array(json_ids(t)[a:a + 1024], "<u4").tobytes()) for _, t in rows
                      for a in range(0, len(json_ids(t)), 1024))
    assert sorted(r.ids_crc32 for r in out) == expected
    fill = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert all(v <= 1024 for v in fill.values())


def test_license_rows(spark):
    out = scan_licenses(docs(spark)).collect()
    assert len(out) == len(TEXTS)
    one = next(r for r in out if r.doc_id == 1)
    assert (one.n_base, one.first_word, one.last_word, one.base_labels, one.labels, one.score) == (1, 3, 4, "mit", "mit,mit-notice", 1.0)
    for r in out:
        if r.doc_id in (2, 3, 4):
            assert (r.n_words, r.n_base, r.first_word, r.base_labels, r.labels, r.score) == (0, 0, None, "", "", 0.0)
    assert scan_licenses(docs(spark, [])).count() == 0


def test_license_phrases_against_brute_force(spark):
    import random
    rng = random.Random(3)
    vocabulary = ["mit", "license", "apache", "general", "public", "the", "MIT", "License.", "x9"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))) for i in range(200)]
    for r in scan_licenses(docs(spark, rows)).collect():
        import re
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", dict(rows)[r.doc_id].lower())
        hits = [(i, i + len(p) - 1) for p in (["mit", "license"], ["apache", "license"], ["general", "public", "license"])
                for i in range(len(words)) if words[i:i + len(p)] == p]
        assert r.n_words == len(words) and r.n_base == len(hits)
        assert (r.first_word, r.last_word) == ((min(hits)[0], max(h[1] for h in hits)) if hits else (None, None))


def test_token_counts_equal_the_library(spark):
    import random

    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    rng = random.Random(5)
    more = [(i, "".join(rng.choice("ab th\n  ▁é漢😀.") for _ in range(rng.randrange(900)))) for i in range(100, 160)]
    rows = TEXTS + more + [(200, " " * 700 + "end"), (201, "ab" * 900)]
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in token_counts(docs(spark, rows), P.path("piece_bpe_32k.model")).collect())
    assert got == sorted((i or 0, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in rows)


def test_near_duplicates(spark):
    base = [f"w{i}" for i in range(100)]
    rows = TEXTS + [(20, " ".join(base)), (21, " ".join(base[:-1])), (22, " ".join(base).upper()), (23, " ".join(base[50:]))]
    out = {r.doc_id: r for r in near_duplicates(docs(spark, rows), shingle=3, percent=85).collect()}
    assert out[20].component_id == out[21].component_id == out[22].component_id == 20 and not out[21].kept
    assert out[23].component_id == 23 and out[6].n_shingles == 1 and out[6].kept
    assert all(out[i].n_shingles == 0 and out[i].kept for i in (2, 3, 4))
    assert near_duplicates(docs(spark, [])).count() == 0


def test_decontamination_tolerates_substitutions(spark):
    item = [f"q{i}" for i in range(20)]
    items = spark.createDataFrame([(1, " ".join(item), "x"), (2, "too short", "x"), (3, None, "x")], "item_id bigint, text string, words string")
    changed = ["zz" if i in (3, 9, 15) else w for i, w in enumerate(item)]
    other = ["zz" if i % 2 else w for i, w in enumerate(item)]
    rows = TEXTS + [(30, "before " + " ".join(changed).upper() + " after"), (31, " ".join(other)), (32, " ".join(item[:6])),
                    (33, " ".join(item[:14]) + " cut")]
    for limit in (1 << 26, 0):  # broadcast and shuffle plans
        out = {(r.doc_id, r.item_id): r.matches for r in contaminated(docs(spark, rows), items, max_broadcast=limit).collect()}
        assert out == {(30, 1): 17, (33, 1): 14}
    assert contaminated(docs(spark, []), items).count() == 0
    assert contaminated(docs(spark), items.limit(0)).count() == 0
    plan = contaminated(docs(spark), items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_vectors(spark):
    a, b = [1.0, 0.0, 0.0], [0.99, 0.05, 0.0]
    rows = [(1, a, 0), (2, a, 0), (3, b, 0), (4, a, 1), (5, None, 0), (6, [0.0] * 3, 0), (7, [float("nan"), 1.0, 0.0], 0),
            (8, [None, 1.0, 0.0], 0), (9, a, None), (None, a, 0), (10, [1.0, 0.0], 0), (11, [0.0, 1.0, 0.0], 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, rep string")
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(df, block=1).collect()}
    assert out[1] == (2, 1, True) and out[2] == (2, 1, False) and out[3] == (2, 1, False)
    for i in (4, 5, 6, 7, 8, 9, 10, 11):
        assert out[i] == (0, i, True)
    assert near_duplicate_vectors(df.limit(0)).count() == 0


def test_archives(spark, scratch):
    big = "<p>é WARC/1.1\r\n\r\n" + "x" * 1500
    rows = [(1, "http://b.a/x?y", big), (2, "http://b.a/x?y", big), (3, None, big), (4, "http://c.d/\r\nz", "small"), (5, "u", "small"),
            (6, "::", None), (None, "http://n", "no id")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id bigint, url string, html string, bytes string")
    path = scratch("warc")
    write_archives(df, path, records_per_file=2)
    index = capture_histories(spark, path).collect()
    out = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in index}
    size = len(big.encode())
    assert out[1] == ("revisit", 3, size) and out[2] == ("revisit", 3, size) and out[3] == ("response", None, size)
    assert out[4][0] == out[5][0] == "response" and out[6] == ("response", None, 0) and out[None][0] == "response"
    keys = [(r.urlkey, r.captured) for r in index]
    assert keys == sorted(keys) and len(keys) == len(rows)
    empty = scratch("warc-empty")
    write_archives(df.limit(0), empty)
    assert capture_histories(spark, empty).count() == 0


def test_rotation(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "ann", "hi"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (None, None, None, "z"), (2, 0, "system", "x")]
    df = spark.createDataFrame([(*r, "p") for r in rows], "conv_id bigint, turn bigint, role string, text string, part string")
    out = {(r.conv_id, r.speaker): r for r in rotate(df, part_turns=1000).collect()}
    assert set(out) == {(1, "ann"), (1, "bob"), (None, "unknown")}
    ann = out[1, "ann"]
    assert [ann.rendered[m.start:m.end] for m in ann.mask] == ["hi"] and "<|user name=bob|>" in ann.rendered
    assert rotate(df.limit(0)).count() == 0


def test_quality_keeps_the_usual_and_drops_the_strange(spark):
    import random
    rng = random.Random(1)
    say = lambda n: " ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat", "and", "ran"]) for _ in range(n))
    rows = [(i, say(60)) for i in range(100, 160)] + [(1, "#$%" * 80), (2, None), (3, ""), (4, say(80)), (None, say(5))]
    trusted = spark.createDataFrame([(i,) for i in range(100, 160)], "doc_id bigint")
    out = {r.doc_id: r for r in score_quality(docs(spark, rows), trusted).collect()}
    assert not out[1].kept and out[4].kept and not out[2].kept and out[3].perplexity is None
    assert sum(not out[i].kept for i in range(100, 160)) == 0
    assert score_quality(docs(spark, []), trusted).count() == 0
    untrained = {r.doc_id: r.kept for r in score_quality(docs(spark, rows), trusted.limit(0)).collect()}
    assert untrained[1] and untrained[4]


def test_toxicity_finds_gapped_insults(spark):
    import random
    rng = random.Random(2)
    plain = lambda: [rng.choice(["stone", "river", "green", "walks", "table", "house", "quiet"]) for _ in range(30)]
    rows, labels = [], []
    for i in range(300):
        words, bad = plain(), i % 3 == 0
        if bad:
            words[rng.randrange(30)] = rng.choice(["scoundrel", "nitwit"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    rows += [(900, "you nit-wit of a river"), (901, "n i t w i t stone"), (902, "nitxwit table"), (903, "green table house"), (904, None), (905, ""), (None, "x")]
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    out = {r.doc_id: r.predicted for r in score_toxicity(docs(spark, rows), known).collect()}
    assert [out[i] for i in (900, 901, 902, 903, 904, 905)] == [1, 1, 1, 0, 0, 0]
    assert all(out[i] == t for i, t in labels if zlib.crc32(str(i).encode()) % 3 == 1)
    assert score_toxicity(docs(spark, []), known).count() == 0
    assert {r.score for r in score_toxicity(docs(spark), known.limit(0)).collect()} == {0.0}
