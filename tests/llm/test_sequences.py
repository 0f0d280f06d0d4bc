"""Token records, collocations and periodic runs against brute-force versions, on whole small tables with edge rows."""

import hashlib
import json
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import periods, phrases, records, tokens

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"


def plain_ids(texts, end):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


def test_encoder_equals_plain_encoding_on_odd_texts():
    import pyarrow as pa
    odd = ["Foo,bar's  don't x　y ΑΣ Σ Straße ÉCOLE é <|startoftext|> a<|endoftext|>b 12,5% x\x1cy\x85z \x00 ﬁ İstanbul",
           "... a.. 'll they'll,'s 日本語。テスト 😀a😀 é.é, ñ a̸ ≮", None, "", " \t\n", "a" * 3000, "_x_ #tag a|b A<b>c", "x' s 's's"]
    encoder = tokens.Encoder(TOKENIZER, limit=5)
    assert encoder.direct
    for _ in range(3):  # what is remembered, moved and forgotten gives the same ids
        flat, bounds = encoder.encode(pa.array(odd, pa.string()))
        assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [x[:-1] for x in plain_ids(odd, 2)]


def test_encoder_equals_plain_encoding_of_whole_texts(rows):
    import pyarrow as pa
    texts = [r["text"] for r in rows] + [
        "It's a don't, we'll; x's. (a) 1,234.5! a\x1cb <|endoftext|> caf\u00e9... cafe\u0301, \u039f\u0394\u039f\u03a3 \u0130stanbul",
        "\u212aelvin \u1112\u1161\u11ab \u00a0 a\u2003b\u0085c .. ?! \u00df\u1e9e a\u200db 'S 't"]
    flat, bounds = tokens.Encoder(TOKENIZER).encode(pa.array(texts, pa.string()))
    assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [x[:-1] for x in plain_ids(texts, 2)]


def test_stretches_cover_all_texts():
    import pyarrow as pa
    texts = pa.array(["a" * n for n in (5, 0, 40, 1, 1, 1, 30)] + [None])
    cuts = list(tokens.stretches(texts, 10))
    assert [a for a, _ in cuts] == [0] + [b for _, b in cuts[:-1]] and cuts[-1][1] == 8
    assert list(tokens.stretches(texts.slice(0, 0), 10)) == []


def crc32c(data):
    state = 0xFFFFFFFF
    for x in data:
        state ^= x
        for _ in range(8):
            state = (state >> 1) ^ (0x82F63B78 if state & 1 else 0)
    return state ^ 0xFFFFFFFF


def test_checksums_of_many_ranges():
    rng = np.random.default_rng(1)
    data = np.concatenate([np.frombuffer(b"123456789", np.uint8), rng.integers(0, 256, 5000, np.uint8)])
    starts, sizes = np.array([0, 3, 9, 100, 700, 0]), np.array([9, 4, 64, 65, 4000, 5009])
    got = records.Crc32c().of(data, starts, sizes)
    assert got[0] == 0xE3069283  # the published check value
    assert got.tolist() == [crc32c(data[a: a + n].tobytes()) for a, n in zip(starts, sizes)]


def test_permutation_is_one():
    for n in (1, 2, 5, 64, 1000):
        assert sorted(records.Permutation(n, 3)(np.arange(n)).tolist()) == list(range(n))


def expected_records(rows):
    """In ascending id order (null ids first); rows of one id stand together in any order."""
    ids = plain_ids([r["text"] for r in rows], records.END)
    at, out = 0, Counter()
    order = sorted(range(len(rows)), key=lambda k: (rows[k]["doc_id"] is not None, rows[k]["doc_id"] or 0))
    for k in order:
        out[(rows[k]["doc_id"], at, len(ids[k]), zlib.crc32(np.array(ids[k], "<u4").tobytes()))] += 1
        at += len(ids[k])
    return out


def test_records_round_trip_index_and_shuffled_reads(spark, edge_docs, rows, tmp_path):
    path = f"file://{tmp_path}/r"
    records.write_records(edge_docs, TOKENIZER, path, file_bytes=100_000)
    manifest = json.load(open(tmp_path / "r/manifest.json"))
    assert len(manifest["files"]) > 3 and not [f for f in os.listdir(tmp_path / "r") if f.endswith(".tmp")]
    got = records.read_records(spark, path).collect()
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == expected_records(rows)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in got)
    assert sorted(r.record for r in got) == list(range(len(rows)))
    shuffled = records.read_records(spark, path, seed=5, with_ids=False).collect()
    assert [r.record for r in shuffled] != sorted(r.record for r in shuffled)
    assert sorted(tuple(r) for r in shuffled) == sorted(tuple(r)[:5] for r in got) if None not in {r.doc_id for r in got} else (
        Counter(tuple(r) for r in shuffled) == Counter(tuple(r)[:5] for r in got))


def test_records_empty_table_and_one_id_over_many_files(spark, no_docs, tmp_path):
    assert records.round_trip(no_docs, TOKENIZER, f"file://{tmp_path}/e").count() == 0
    same = spark.range(400).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("one text of several words").alias("text"))
    records.write_records(same, TOKENIZER, f"file://{tmp_path}/s", file_bytes=2000)
    assert len(json.load(open(tmp_path / "s/manifest.json"))["files"]) > 3
    got = records.read_records(spark, f"file://{tmp_path}/s").collect()
    assert len(got) == 400 and len({r.start for r in got}) == 400 and len({r.ids_crc32 for r in got}) == 1


def test_a_damaged_record_is_an_error(spark, tmp_path):
    path = f"file://{tmp_path}/d"
    df = spark.createDataFrame([(1, "some words"), (2, "more words here")], "doc_id bigint, text string").coalesce(1)
    records.write_records(df, TOKENIZER, path)
    name = next(f for f in os.listdir(tmp_path / "d") if f.endswith(".records"))
    raw = bytearray((tmp_path / "d" / name).read_bytes())
    raw[-6] ^= 1
    (tmp_path / "d" / name).write_bytes(raw)
    with pytest.raises(Exception, match="checksum"):
        records.read_records(spark, path).collect()


def brute_collocations(rows, least, longest, top):
    counts, totals = Counter(), Counter()
    for r in rows:
        lang = "und" if r["lang"] is None else r["lang"]
        text = (r["text"] or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for at in range(len(words) - k + 1):
                    counts[lang, tuple(words[at: at + k])] += 1
    frequent = {k: n for k, n in counts.items() if n >= least}
    covered = set()
    for (lang, words), n in frequent.items():
        for a in range(len(words)):
            for b in range(a + 1, len(words) + 1):
                if b - a < len(words) and n >= counts[lang, words[a:b]]:
                    covered.add((lang, words[a:b]))
    best = {}
    for (lang, words), a in frequent.items():
        if len(words) < 2 or (lang, words) in covered:
            continue
        cuts = []
        for k in range(1, len(words)):
            x, y = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (x * y), k, x, y))
        score, _, x, y = min(cuts)
        best.setdefault(lang, []).append((score, a, " ".join(words), x, y))
    out = set()
    for lang, found in best.items():
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out |= {(lang, rank, p, a, x, y, totals[lang], s) for rank, (s, a, p, x, y) in enumerate(found[:top], 1)}
    return out


@pytest.mark.parametrize("least,top,stretch", [(3, 2000, 20_000), (2, 50, 8 << 20)])
def test_collocations(edge_docs, rows, least, top, stretch):
    got = phrases.collocations(edge_docs, least=least, top=top, stretch_bytes=stretch).collect()
    assert {tuple(r) for r in got} == brute_collocations(rows, least, 5, top) and len(got) == len({tuple(r) for r in got})
    assert got


def test_collocations_of_overlaps_ties_and_languages(spark):
    texts = [("en", "a a a a a, a a\tB"), ("en", "A a. a b? a b! c\x0bd c\x0cd"), (None, "x y x y x y"), ("und", "x y;x y"), ("de", None),
             ("fr", "é z é z"), ("en", "")] * 3
    df = spark.createDataFrame(texts, "lang string, text string").withColumn("n", F.lit(1)).withColumn("word", F.lit("w"))
    rows = [r.asDict() for r in df.collect()]
    for least in (1, 3, 10):
        got = {tuple(r) for r in phrases.collocations(df, least=least, stretch_bytes=10).collect()}
        assert got == brute_collocations(rows, least, 5, 2000)


def test_collocations_of_an_empty_table_and_without_pairs(spark, no_docs):
    assert phrases.collocations(no_docs, least=1).count() == 0
    df = spark.createDataFrame([("en", "a,b,c"), ("en", "  ")], "lang string, text string")
    assert phrases.collocations(df, least=1).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    """Scores of large counts, by the expression the operator uses."""
    a, n, x, y = 99_999_999_977, 999_999_999_999_989, 100_000_000_003, 99_999_999_977
    got = spark.sql(f"select cast({a}L as decimal(18,0)) * cast({n}L as decimal(18,0)) * 1000 div "
                    f"(cast({x}L as decimal(18,0)) * cast({y}L as decimal(18,0))) as s").first().s
    assert got == 1000 * a * n // (x * y)


def brute_runs(words, least=12):
    out, n = {}, len(words)
    for p in range(1, n // 2 + 1):
        start = None
        for i in range(n - p + 1):
            same = i + p < n and words[i] == words[i + p]
            if same and start is None:
                start = i
            if not same and start is not None:
                length = i + p - start
                if length >= max(least, 2 * p):
                    out.setdefault((start, length), p)  # periods ascend: the smallest stays
                start = None
    return sorted((s, n_, p) for (s, n_), p in out.items())


def test_runs_of_random_and_periodic_words():
    rng = random.Random(4)
    for trial in range(300):
        letters = rng.choice([1, 2, 3, 6])
        texts = []
        for _ in range(rng.randint(1, 4)):
            words = [rng.randrange(letters) for _ in range(rng.randint(0, 40))]
            if rng.random() < 0.6 and words:
                loop = words[: rng.randint(1, 9)]
                words += loop * rng.randint(1, 8) + loop[: rng.randint(0, len(loop))]
            texts.append(words)
        owner = np.repeat(np.arange(len(texts)), [len(w) for w in texts])
        least = rng.choice([2, 5, 12])
        got = periods.runs_of(np.array([x for w in texts for x in w], np.int64), owner, least).tolist()
        want, at = [], 0
        for words in texts:
            want += [[s + at, n, p] for s, n, p in brute_runs(words, least)]
            at += len(words)
        assert got == want, (texts, least)


def test_suffix_ranks_and_common_prefixes():
    rng = random.Random(2)
    words = [rng.randrange(3) for _ in range(200)] * 2
    levels, order = periods.suffix_ranks(np.array(words), 6)
    lcp = periods.common_prefixes(levels, order[:-1], order[1:])
    assert order.tolist() == sorted(order.tolist(), key=lambda i: words[i:])
    for a, b, n in zip(order, order[1:], lcp):
        assert words[a: a + n] == words[b: b + n] and words[a + n: a + n + 1] != words[b + n: b + n + 1]


def brute_periods(doc_id, text, loops):
    words = (text or "").encode().split()
    if loops and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(((-n, s, p) for s, n, p in runs), default=None)
    first = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *first, hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


@pytest.mark.parametrize("loops", [False, True])
def test_periodic_runs(edge_docs, rows, loops):
    short = [r for r in rows if len(r["text"] or "") < 20_000]
    words_of = periods.looped_words if loops else periods.split_words
    got = periods.periodic_runs(edge_docs.where("text is null or length(text) < 20000"), words_of=words_of).collect()
    assert Counter(tuple(r) for r in got) == Counter(brute_periods(r["doc_id"], r["text"], loops) for r in short)
    if loops:
        assert sum(r.n_runs > 0 for r in got) >= 15


def test_periodic_runs_of_long_texts_and_an_empty_table(spark, no_docs):
    assert periods.periodic_runs(no_docs).count() == 0
    texts = [(1, "w " * 60_000), (2, "a b c " * 30_000 + "d"), (3, "x y " * 5 + "z"), (None, "q " * 12)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("start", F.lit("s"))
    got = {r.doc_id: r for r in periods.periodic_runs(df, with_runs=True).collect()}
    assert got[1].runs == [[0, 60_000, 1]] and got[2].runs == [[0, 90_000, 3]] and got[3].n_runs == 0
    assert (got[None].start, got[None].length, got[None].period, got[None].exponent_milli) == (0, 12, 1, 12_000)
