"""The numbered operators against brute force, round trips and held-out accuracy, on small fixtures with the hard cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import byte_bpe, exact_dedup, html_extract, language_id, license_scan, media, near_dedup, ngram_lm, packing, shingles, token_store
from cohortloom.llm.components import connected_components

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Names that operators use inside; in a table they must do no harm.
CLASH = "row_uid string, run int, digest string, band long, label string, length int, ids string, sig int, __text string, piece string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
SPACES = r"[\x20\x09-\x0D]+"


def table(spark, rows):
    """rows of (doc_id, text) or (doc_id, text, lang)."""
    return spark.createDataFrame([(*r, *[None] * (3 - len(r)), "s", 1, "x", 2, "d", 3, "l", 4, "i", 5, "t", "p") for r in rows], SCHEMA).repartition(3)


def words_of(rnd, n):
    return " ".join(rnd.choice("alpha beta gamma Delta epsilon zeta eta theta iota kappa la mu nu".split()) + str(rnd.randint(0, 9)) for _ in range(n))


@pytest.fixture(scope="module")
def hard():
    rnd = random.Random(5)
    base = words_of(rnd, 120)
    near = base.split()
    near[60] = "changed"
    far = base.split()
    far[::7] = ["x"] * len(far[::7])
    long = words_of(rnd, 6000)
    return [
        (1, base), (2, base), (2, base), (3, " ".join(near)), (4, " ".join(far)), (5, None), (6, ""), (7, " \t\n "), (8, "one two"), (9, "one  two"), (10, "ONE two"),
        (11, long), (12, long + " tail"), (None, base), (None, "lonely row without an id and with words"), (13, "Ünïcode ß 中文 🙂 é İ ς Σ"), (14, "!!! ... 123"), (15, "x" * 5000),
        (16, "a<|endoftext|>b \x01 \x1c c"), (19, "x <|ENDOFTEXT|> Y <|startoftext|>"), (20, "<|endoftext|>"), (17, base.replace(" ", "\n")), (18, "Released under the MIT License.\nOther things follow here. And more."),
    ]


def test_media_round_trip_and_digests(spark, hard):
    got = sorted(media.media_table(table(spark, hard)).collect(), key=str)
    assert len(got) == len(hard)
    by_text = {}
    for r in got:
        want = [t for i, t in hard if i == r.doc_id]
        payloads = []
        for t in want:
            data = (t or "").encode()
            n = max(576, -(-len(data) // 576) * 576)
            payloads.append((len(data), data + b"\xff" * (n - len(data))))
        assert (r.n_bytes, r.payload_sha256) in [(n, hashlib.sha256(p).hexdigest()) for n, p in payloads]
        p = next(p for n, p in payloads if hashlib.sha256(p).hexdigest() == r.payload_sha256)
        assert r.payload_bytes == len(p) and r.tail_crc32 == zlib.crc32(p[-32:]) and r.problem is None and len(r.phash) == 8
        assert by_text.setdefault(r.payload_sha256, (r.media_sha256, bytes(r.phash))) == (r.media_sha256, bytes(r.phash))
    assert media.media_table(table(spark, [])).count() == 0


def naive_png(data):
    """Rows of samples of a PNG file, chunk by chunk and sample by sample."""
    assert data[:8] == b"\x89PNG\r\n\x1a\n"
    at, body = 8, b""
    while at < len(data):
        size, kind = int.from_bytes(data[at : at + 4], "big"), data[at + 4 : at + 8]
        assert int.from_bytes(data[at + 8 + size : at + 12 + size], "big") == zlib.crc32(data[at + 4 : at + 8 + size])
        if kind == b"IHDR":
            width, height = (int.from_bytes(data[at + 8 + 4 * k : at + 12 + 4 * k], "big") for k in (0, 1))
        body += data[at + 8 : at + 8 + size] if kind == b"IDAT" else b""
        at += 12 + size
    raw, above, out = zlib.decompress(body), [0] * width, []
    for y in range(height):
        kind, *row = raw[y * (width + 1) : (y + 1) * (width + 1)]
        for x in range(width):
            a, b, c = row[x - 1] if x else 0, above[x], above[x - 1] if x else 0
            paeth = min((abs(a + b - c - v), k, v) for k, v in enumerate((a, b, c)))[2]
            row[x] = (row[x] + (0, a, b, (a + b) // 2, paeth)[kind]) % 256
        out.append(row)
        above = row
    return out


def direct_hash(image):
    height, width = image.shape
    share = lambda k, n, x: max(0.0, min((k + 1) * n / 32, x + 1) - max(k * n / 32, x)) * 32 / n
    rows = [[share(k, height, y) for y in range(height)] for k in range(32)]
    columns = [[share(k, width, x) for x in range(width)] for k in range(32)]
    pooled = np.array(rows) @ image.astype(float) @ np.array(columns).T
    low = [sum(pooled[y, x] * math.cos(math.pi * u * (y + 0.5) / 32) * math.cos(math.pi * v * (x + 0.5) / 32) for y in range(32) for x in range(32)) for u in range(8) for v in range(8)]
    middle = sorted(round(c, 4) for c in low[1:])[31]
    return int("".join("1" if round(c, 4) > middle else "0" for c in low), 2).to_bytes(8, "big")


def test_stored_images_open_in_another_reader():
    rnd = np.random.default_rng(3)
    for height in (1, 2, 9):
        smooth = np.cumsum(rnd.integers(-2, 3, (height, 64)), axis=1).astype(np.uint8)
        for image in (rnd.integers(0, 256, (height, 64), np.uint8), smooth, np.repeat(smooth[:1], height, axis=0)):
            assert naive_png(media.encode_png(image)) == image.tolist() == media.decode_png(media.encode_png(image)).tolist()


def test_png_filters_and_damage(spark):
    rnd = np.random.default_rng(1)
    image = rnd.integers(0, 256, (5, 9), np.uint8)

    def predicted(kind, y, x):
        a = int(image[y, x - 1]) if x else 0
        b = int(image[y - 1, x]) if y else 0
        c = int(image[y - 1, x - 1]) if x and y else 0
        p = a + b - c
        paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
        return (0, a, b, (a + b) // 2, paeth)[kind]

    kinds = np.arange(5, dtype=np.uint8)
    rows = np.array([[(int(image[y, x]) - predicted(k, y, x)) % 256 for x in range(9)] for y, k in enumerate(kinds)], np.uint8)
    assert (media._unfilter(kinds, rows) == image).all()
    for _ in range(30):  # runs of rows of one filter
        kinds = np.sort(rnd.integers(0, 5, 8)).astype(np.uint8)[rnd.permutation(8) if rnd.random() < 0.5 else slice(None)]
        rows = rnd.integers(0, 256, (8, 12), np.uint8)
        raw = b"".join(bytes([k]) + row.tobytes() for k, row in zip(kinds.tolist(), rows, strict=True))
        header = (12).to_bytes(4, "big") + (8).to_bytes(4, "big") + bytes([8, 0, 0, 0, 0])
        png = media._SIGNATURE + media._chunk(b"IHDR", header) + media._chunk(b"IDAT", zlib.compress(raw)) + media._chunk(b"IEND", b"")
        assert naive_png(png) == media.decode_png(png).tolist()
    good = media.encode_png(image)
    assert (media.decode_png(good) == image).all()
    for at in range(len(good)):
        with pytest.raises(ValueError):
            media.decode_png(good[:at] + bytes([good[at] ^ 1]) + good[at + 1 :])
        with pytest.raises(ValueError):
            media.decode_png(good[:at])
    got = media.media_features(spark.createDataFrame([(1, bytearray(good)), (2, None), (3, bytearray(b"no"))], "k int, media binary")).orderBy("k").collect()
    assert [r.problem for r in got] == [None, "null", "not a PNG file"] and got[1].media_bytes is None and got[2].media_bytes == 2


def test_frequency_hash_is_its_direct_transform():
    """The lowest cosine coefficients summed term by term."""
    rnd = np.random.default_rng(4)
    for shape in ((1, 576), (7, 576), (40, 576)):
        image = rnd.integers(0, 256, shape, np.uint8)
        assert media.frequency_hash(image) == direct_hash(image)


def test_frequency_hash_is_near_for_near_images():
    rnd = np.random.default_rng(2)
    image = np.cumsum(rnd.integers(-3, 4, (96, 576)), axis=1).astype(np.float64)
    image = ((image - image.min()) / np.ptp(image) * 255).astype(np.uint8)
    bits = lambda x: np.unpackbits(np.frombuffer(media.frequency_hash(x), np.uint8))
    noisy = np.clip(image.astype(int) + rnd.integers(-4, 5, image.shape), 0, 255).astype(np.uint8)
    assert (bits(image) != bits(noisy)).sum() <= 4 < (bits(image) != bits(image[::-1, ::-1])).sum()


def naive_best_fit(lengths, capacity):
    import bisect

    rooms, bins = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, n)
        room = rooms.pop(at) if at < len(rooms) else capacity
        bins += room == capacity
        if room - n:
            bisect.insort(rooms, room - n)
    return bins


@pytest.mark.parametrize("seed", range(12))
def test_best_fit_plan_is_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([7, 32, 100, 2048])
    lengths = [rnd.randint(1, rnd.choice([capacity, max(1, capacity // 5)])) for _ in range(rnd.randint(1, 400))]
    counts = Counter(lengths)
    plan = list(packing.best_fit_plan(counts, capacity))
    filled = defaultdict(list)
    for n, first_rank, first_bin, fits, offset in plan:
        end = min([r for m, r, *_ in plan if m == n and r > first_rank], default=counts[n])
        for k in range(end - first_rank):
            filled[first_bin + k // fits].append((offset + k % fits * n, n))
    assert sum(map(len, filled.values())) == len(lengths)
    for pieces in filled.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(filled) == naive_best_fit(lengths, capacity)


def expected_ids(text, end):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(TOKENIZER)
    return library.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing(spark, hard):
    got = packing.pack_documents(table(spark, hard), TOKENIZER).collect()
    want = Counter()
    for i, t in hard:
        ids = expected_ids(t, 0)
        want.update((i, k, a, len(ids[a : a + 2048]), crc(ids[a : a + 2048])) for k, a in enumerate(range(0, len(ids), 2048)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        assert [o for o, _ in sorted(pieces)] == list(np.cumsum([0] + [n for _, n in sorted(pieces)])[:-1]) and sum(n for _, n in pieces) <= 2048
    assert len(bins) == naive_best_fit([r.length for r in got], 2048)
    assert packing.pack_documents(table(spark, []), TOKENIZER).count() == 0


def test_token_ids_of_odd_texts_are_those_of_the_library():
    from tokenizers import Tokenizer

    from cohortloom.llm.words import id_bytes

    library, rnd = Tokenizer.from_file(TOKENIZER), random.Random(1)
    pieces = [" ", "\n", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", "it's", "don't", "abc", "ÀÉ", "straße", "12", "½", "...", "中文", "🙂", "\x1c", "\u00a0", "İ", "e\u0301"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 9))) for _ in range(3000)]
    for text, ids in zip(texts, id_bytes(TOKENIZER)(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_token_store_keeps_ids_exactly(spark):
    """Ids beyond 2**53 beside a null one, and more copies of an id than a part holds."""
    rows = [(2**53 + 1, "one"), (2**53 + 2, "two words"), (None, "none"), (7, None)] + [(2**60 + 1, f"copy {i}") for i in range(40)]
    got = token_store.stored_digests(table(spark, rows), TOKENIZER, 49408, 2).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, len(expected_ids(t, 2)), crc(expected_ids(t, 2))) for i, t in rows)
    assert sorted(r.start for r in got) == np.cumsum([0] + [r.n_tokens for r in sorted(got, key=lambda r: r.start)])[:-1].tolist()


def test_token_store(spark, hard):
    docs = table(spark, hard)
    got = token_store.stored_digests(docs, TOKENIZER, 49408, 2).collect()
    want = Counter((i, len(expected_ids(t, 2)), crc(expected_ids(t, 2))) for i, t in hard)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    store = token_store.write_store(docs, TOKENIZER, 49408, 2)
    asked = spark.createDataFrame([(1, 0), (2, 1), (2, 2), (999, 0), (12, 0)], "doc_id long, copy int")
    assert sorted((r.doc_id, r.copy) for r in token_store.find(store, asked).collect()) == [(1, 0), (2, 1), (12, 0)]
    fetched = {(r.doc_id, r.copy): np.frombuffer(bytes(r.ids), "<u4").tolist() for r in token_store.fetch_ids(store, asked).collect()}
    assert fetched == {(i, k): expected_ids(dict(hard)[i], 2) for i, k in [(1, 0), (2, 1), (12, 0)]}
    assert token_store.stored_digests(table(spark, []), TOKENIZER, 49408, 2).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 4000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, n, np.uint64)
    places = token_store.perfect_hash(keys, token_store.build_perfect_hash(keys), n)
    assert sorted(places.tolist()) == list(range(n))


def test_exact_dedup(spark, hard):
    got = exact_dedup.exact_dedup(table(spark, hard), runs=5, fan_in=2).collect()
    normal = lambda t: re.sub(SPACES, " ", t or "")
    groups = defaultdict(list)
    for i, t in hard:
        groups[normal(t)].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_dedup.exact_dedup(table(spark, [])).count() == 0


def brute_sets(rows):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    out = []
    for _, t in rows:
        w = [x for x in re.split(SPACES, (t or "").translate(lower)) if x]
        out.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return out


def brute_components(rows):
    sets = brute_sets(rows)
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    smallest = {k: min((rows[i][0] for i in range(len(rows)) if label[i] == k and rows[i][0] is not None), default=None) for k in set(label)}
    return Counter((rows[i][0], len(sets[i]), smallest[label[i]] if sets[i] else rows[i][0]) for i in range(len(rows)))


def test_near_dedup_on_hard_rows(spark, hard):
    got = near_dedup.near_dedup(table(spark, hard)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(hard)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert near_dedup.near_dedup(table(spark, [])).count() == 0


def test_near_dedup_on_a_large_group(spark, monkeypatch):
    """Copies with growing numbers of edits, in blocks smaller than their buckets."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rnd = random.Random(9)
    rows, base = [], words_of(rnd, 90).split()
    for i in range(150):
        copy = base[:]
        for _ in range(rnd.randint(0, 6)):
            copy[rnd.randrange(len(copy))] = f"e{rnd.randint(0, 10**6)}"
        rows.append((i, " ".join(copy)))
    rows += [(200 + i, words_of(rnd, 80)) for i in range(30)]
    got = near_dedup.near_dedup(table(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows)


def test_near_dedup_on_shared_boilerplate(spark, monkeypatch):
    """Many documents of several components share bands: joined by prefixes, in blocks and by hubs in several places."""
    rnd = random.Random(10)
    boiler = words_of(rnd, 60)
    rows = []
    for i in range(120):
        own = [f"u{rnd.randint(0, 10**9)}" for _ in range(30)]
        rows.append((3 * i, boiler + " " + " ".join(own)))
        if i % 3 == 0:
            rows.append((3 * i + 1, boiler + " " + " ".join(own[:-1])))
        if i % 6 == 0:
            rows.append((3 * i + 2, " ".join([*own[:2], boiler, *own[2:-4]])))
    rows += [(1000 + i, " ".join(boiler.split()[: 20 + i])) for i in range(40)]
    want = brute_components(rows)
    for block, rest, together, frequent in ((8, 4, 16, 10), (8, 10**6, 16, 1000), (256, 4, 512, 1000)):
        for name, value in (("BLOCK", block), ("REST", rest), ("TOGETHER", together), ("FREQUENT", frequent)):
            monkeypatch.setattr(near_dedup, name, value)
        got = near_dedup.near_dedup(table(spark, rows)).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_rows_of_a_large_bucket_grow_with_its_members(spark):
    """One band of 20 000 members: blocks for a component and a few others, prefixes for members all apart."""
    n = 20_000
    of = lambda k, labels: spark.range(k).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("digest"), (F.col("id") % labels).cast("string").cast("binary").alias("label"), F.lit(100).alias("n_shingles"), F.lit(1).cast("long").alias("band"), F.lit(k).alias("n_members"))
    few = of(n, 1).where("rand(1) < 2").withColumn("label", F.when(F.rand(2) < 0.002, F.col("digest")).otherwise(F.col("label"))).persist()
    mixed = near_dedup._mixed(few)
    assert mixed.first()["rest"] < 100 and near_dedup._block_rows(few, mixed).count() < 1.7 * n
    apart = of(n, n)
    assert near_dedup._mixed(apart).first()["rest"] == n - 1 > near_dedup.REST
    common, rnd = np.arange(40, dtype=np.int64), np.random.default_rng(0)
    sets = spark.createDataFrame([(bytes(r.digest), bytearray(np.sort(np.concatenate((common, rnd.integers(1 << 20, 1 << 62, 60)))).tobytes())) for r in apart.limit(2000).collect()], "digest binary, shingles binary")
    assert near_dedup._rare_members(apart.select("digest", "label"), sets, 75).count() == 0


def test_words_of_other_bytes_hash_apart():
    word = lambda flip: "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(1024))
    made = [word(0), word(1), "a" * 1024, "a" * 1023, "abcdefgh" + "ijklmnop", "ijklmnop" + "abcdefgh", "a", "aa", "\x00a", "a\x00", "a\x00\x00"]
    hashes = [int(shingles.word_hashes(w)[0]) for w in made]
    assert len(set(hashes)) == len(made)
    assert shingles.word_hashes(" ".join(made)).tolist() == hashes


def test_bayesian_bounds():
    for n, least in near_dedup.least_matches(0.75, 1e-6):
        grid = np.linspace(0, 1, 200_001)

        def tail(m, n=n, grid=grid):
            density = np.exp(m * np.log(np.maximum(grid, 1e-300)) + (n - m) * np.log(np.maximum(1 - grid, 1e-300)))
            return density[grid >= 0.75].sum() / density.sum()

        assert least == 0 or tail(least - 1) < 1e-6
        assert tail(least) >= 0.99e-6


def test_connected_components(spark):
    rnd = random.Random(3)
    pairs = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(230)] + [(1000 + i, 1001 + i) for i in range(40)]
    label = {v: v for p in pairs for v in p}
    for _ in range(400):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.vertex: r.label for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {v: got.get(v, v) for v in label} == label


def test_shingles_of_odd_texts():
    rows = [(0, t) for t in ("", " ", "a", " a ", "a b", "a b c d e", "A b C d e f", "\x0b\x0ca\x1cb c\r\nd", "é É", "a b c d e a b c d e")]
    assert [len(shingles.shingle_hashes(t)) for _, t in rows] == [len(s) for s in brute_sets(rows)]
    assert (shingles.word_hashes("x Yz é") == shingles.word_hashes("\tX yZ  é\n")).all() and not (shingles.word_hashes("é") == shingles.word_hashes("É")).any()


def test_byte_bpe_agrees_with_tiktoken(spark, hard):
    import tiktoken

    ranks = byte_bpe.load_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = byte_bpe.bpe_digests(table(spark, hard), RANKS, public_tokenizers.PATTERN).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for i, t in hard:
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert byte_bpe.encode_bpe(table(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0
    kept = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in byte_bpe.encode_bpe(table(spark, hard), RANKS, public_tokenizers.PATTERN).collect()}
    assert kept[4] == library.encode_ordinary(dict(hard)[4])


def test_byte_bpe_appends_and_edits():
    encoder, rnd = byte_bpe.PrefixEncoder(byte_bpe.load_ranks(RANKS)), random.Random(4)
    for _ in range(200):
        data = bytes(rnd.choice(b"abcdethinrsng") for _ in range(rnd.randint(0, 300)))
        cut = rnd.randint(0, len(data))
        state = encoder.append(encoder.append(byte_bpe.PrefixState(), data[:cut]), data[cut:])
        assert encoder.tokens(state) == encoder.tokens(encoder.append(byte_bpe.PrefixState(), data))
        start = rnd.randint(0, len(data))
        stop = rnd.randint(start, min(len(data), start + 4))
        new = bytes(rnd.choice(b"abcdethi") for _ in range(rnd.randint(0, 5)))
        encoder.replace(state, start, stop, new)
        assert state.last == encoder.append(byte_bpe.PrefixState(), data[:start] + new + data[stop:]).last


LANGUAGES = {
    "en": "the of and to in that with this for on is be was here there where which people",
    "de": "der die das und zu mit auch nicht werden sich eine ueber wenn ist sind wird fuer",
    "fr": "le la les des et que qui dans pour avec sur est sont une aux cette leur plus",
}


def language_rows(n=90):
    rnd = random.Random(8)
    return [(i, " ".join(rnd.choice(words.split()) for _ in range(12)).capitalize(), lang) for i in range(n) for lang, words in [list(LANGUAGES.items())[i % 3]]]


def test_language_id(spark, hard):
    rows = language_rows()
    got = {r.doc_id: r for r in language_id.language_id(table(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, _, lang in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= got[i].score <= 1
        assert got[i].lang_pred == lang
    more = rows + [(1000 + k, t, None) for k, (_, t) in enumerate(hard)] + [(None, "the people of that", "en")]
    got = language_id.language_id(table(spark, more)).collect()
    assert len(got) == len(more)
    for r in got:
        if r.doc_id is not None and r.doc_id >= 1000:
            text = hard[r.doc_id - 1000][1]
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
    assert language_id.language_id(table(spark, [])).count() == 0
    assert {(r.lang_pred, r.score) for r in language_id.language_id(table(spark, [(1, "some text")])).collect()} == {("und", 0.0)}


def test_ftrl_is_its_coordinate_wise_version():
    """Every weight by itself, as the method is written down, against the vectorised fit; and the lasso leaves weights out."""
    rnd = random.Random(11)
    rows = []
    for _ in range(60):
        buckets = sorted(rnd.sample(range(40), rnd.randint(1, 8)))
        rows.append((buckets[0] % 3, np.array(buckets), np.array([rnd.random() for _ in buckets])))
    alpha, beta, l1, l2 = 0.5, 1.0, 0.05, 0.01
    z, n = defaultdict(float), defaultdict(float)

    def weight(j, k):
        lasso = 0.0 if j == "bias" else l1
        if abs(z[j, k]) <= lasso:
            return 0.0
        return -(z[j, k] - math.copysign(lasso, z[j, k])) / ((beta + math.sqrt(n[j, k])) / alpha + l2)

    for _ in range(2):
        for label, buckets, values in rows:
            x = [*zip(buckets.tolist(), values.tolist()), ("bias", 1.0)]
            w = {(j, k): weight(j, k) for j, _ in x for k in range(3)}
            e = [math.exp(sum(w[j, k] * v for j, v in x)) for k in range(3)]
            for j, v in x:
                for k in range(3):
                    g = v * (e[k] / sum(e) - (k == label))
                    sigma = (math.sqrt(n[j, k] + g * g) - math.sqrt(n[j, k])) / alpha
                    z[j, k] += g - sigma * w[j, k]
                    n[j, k] += g * g
    weights, bias = language_id.fit_ftrl(rows, 3, epochs=2, alpha=alpha, beta=beta, l1=l1, l2=l2)
    want = np.array([[weight(j, k) for k in range(3)] for j in range(40)])
    assert np.allclose(weights[:40], want, atol=1e-12) and np.allclose(bias, [weight("bias", k) for k in range(3)], atol=1e-12)
    assert not weights[40:].any() and (want == 0).sum() > (np.array([[z[j, k] for k in range(3)] for j in range(40)]) == 0).sum()


def test_language_model_is_the_same_however_the_table_is_split(spark):
    rows = language_rows()
    one, two = (language_id.fit_language_model(table(spark, part).repartition(n), F.lit(True), per_label=20) for n, part in ((1, rows), (7, rows[::-1])))
    assert one.labels == two.labels and (one.active == two.active).all() and (one.weights == two.weights).all() and one.temperature == two.temperature
    assert len(one.active) < language_id.BUCKETS


def test_number_of_languages_is_a_parameter(spark):
    rows = [(i, f"some words of language number {i % 6} and no other", f"l{i % 6}") for i in range(60)]
    with pytest.raises(ValueError, match="max_labels=5"):
        language_id.language_id(table(spark, rows), max_labels=5)
    assert {r.lang_pred for r in language_id.language_id(table(spark, rows), max_labels=6).collect()} <= {f"l{i}" for i in range(6)}


def test_language_ties_and_sparse_weights():
    buckets, values = np.array([3, 9]), np.array([0.6, 0.8])
    model = language_id.LanguageModel(["aa", "bb"], np.ones(language_id.BUCKETS), np.array([9]), np.array([[1.0, -1.0]]), np.array([0.5, 0.5]), 1.0)
    assert model.logits(buckets, values).tolist() == [1.3, -0.30000000000000004]
    assert model.logits(np.array([3]), np.array([1.0])).argmax() == 0  # a tie


def test_language_counts_cover_all_training_rows(spark):
    rows = language_rows(30)
    df, n = language_id.document_frequencies(table(spark, rows))
    want = np.zeros(language_id.BUCKETS, np.int64)
    for _, t, _ in rows:
        want[language_id.gram_counts(t)[0]] += 1
    assert n == 30 and (df == want).all()


PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><h1>Site</h1><nav><a href=/>Home</a></nav></header><div class="cookie-notice">We use cookies</div>
<article><header><h1>Title &amp;  one</h1></header><p>First <b>bold</b>
 text&nbsp;with <a href="x">a link</a>.<br>Line<p>Unclosed second<div class="ad">Buy now</div><aside>Side</aside><ul><li>item</ul>
<form><label>Name</label><input></form><!-- hidden <p>comment</p> --><section id="comments"><p>Nice post!</p></section><p>Last &lt;one&gt;</p></article>
<div class="sidebar">More</div><footer>&copy; me</footer></body></html>"""


def test_html_extract(spark):
    want = "Title & one\n\nFirst bold text with a link. Line\n\nUnclosed second\n\nitem\n\nLast <one>"
    assert html_extract.main_text(PAGE) == want
    bare = "<body><div><a href=a>Home</a> <a href=b>About</a></div><h2>Story</h2><p>Once upon a time there was a text.</p><p>Short.</p><p>And another one with quite some words.</p><div class=sidebar>More</div><div>Copyright 2020 <a href=x>Terms</a> <a href=y>Privacy</a></div>"
    assert html_extract.main_text(bare) == "Story\n\nOnce upon a time there was a text.\n\nShort.\n\nAnd another one with quite some words."
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "", "x"), (3, "w", "<p>" + "word " * 50_000, "x"), (4, "z", "<div <p a < b", "x")], "page_id long, url string, html string, text string")
    got = Counter((r.page_id, r.url, r.n_chars, len(r.text)) for r in html_extract.extract_pages(pages).collect())
    assert got[1, "u", len(want), len(want)] == 2 and got[2, None, 0, 0] == 1 and got[None, "v", 0, 0] == 1 and got[3, "w", 249_999, 249_999] == 1
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def test_html_tree_fits_its_table():
    tree = html_extract.content_tree()
    assert all(html_extract.is_content(tree, row[:-1]) == bool(row[-1]) for row in html_extract.labelled_table())


ARTICLE = "<h1>Title here</h1><p>" + "some words of an article that goes on " * 20 + "</p><p>Second paragraph it is.</p>"


@pytest.mark.parametrize(
    "page",
    [
        f"<nav><a href=/>Home</a></nav><main class='with-sidebar'>{ARTICLE}</main><footer>x</footer>",
        f"<div class='content no-sidebar'>{ARTICLE}</div><div class=footer>foot text</div>",
        f"<article class='post category-social'>{ARTICLE}</article>",
        f"<article>{ARTICLE}</article><section id='comments'><article><p>Nice post I think so</p></article></section>",
        f"<article>{ARTICLE}</article><aside><article><p>Teaser text to read more</p></article></aside>",
        f"<form id=aspnetForm><div class=menu><a href=x>m</a></div><div>{ARTICLE}</div><div class=sidebar>Side things are here to see</div></form>",
        f"<div class='sidebar-right'><div class=breadcrumb>You are here</div>{ARTICLE}<div class='comment-list'><p>{'reader words ' * 200}</p></div></div>",
    ],
)
def test_html_names_of_layout_and_nested_articles(page):
    want = "Title here\n\n" + ("some words of an article that goes on " * 20).strip() + "\n\nSecond paragraph it is."
    assert html_extract.main_text(page) == want


def test_html_attributes_and_names_inside_an_article():
    assert html_extract.main_text("<p title='Bob's dog'>Hello it's fine and this is a paragraph that has words</p>") == "Hello it's fine and this is a paragraph that has words"
    page = "<article><p>Long enough to be an article.</p><section id='related-work'><h2 id='social-history'>Social history</h2><p>short.</p></section><p id='search-results'>A result.</p></article>"
    assert html_extract.main_text(page).split("\n\n")[1:] == ["Social history", "short.", "A result."]
    page = "<article><p>Text <span class=ad>buy</span> more <span class='comment'>kept</span> text</p><pre><span class='token comment'># c</span></pre></article>"
    assert html_extract.main_text(page) == "Text more kept text\n\n# c"
    assert html_extract.main_text("<section id='comments'><article><p>Nice post I think so</p></article></section>") == ""
    assert html_extract.main_text("<") == "<" and html_extract.main_text("") == html_extract.main_text("<p title='") == html_extract.main_text("<!-- x") == ""


def test_html_takes_time_in_proportion_to_the_page():
    import time

    n = 50_000
    for page in ("<div>" * n + "</span>" * n, "<b hidden>" * n + "</i>" * n, "<div class=widget>" * n + "x", "<svg>" * n, "<a href=x" * n, "<p title='" * n, "<!--" * n, "<li class=ad>" * n + "</ul>" * n, "<script>" * n, "</svg" * n):
        began = time.perf_counter()
        html_extract.main_text(page)
        assert time.perf_counter() - began < 10, page[:20]  # quadratic time is minutes


def flat_blocks(page):
    """The texts between block-level tags, by the standard library's reader, on pages without raw or left-out elements."""
    from html.parser import HTMLParser

    out, now = [], []

    class Reader(HTMLParser):
        def cut(self):
            if text := " ".join("".join(now).split()):
                out.append(text)
            now.clear()

        def handle_starttag(self, tag, attrs):
            if tag in html_extract._BLOCK:
                self.cut()
            elif tag == "br":
                now.append(" ")

        def handle_endtag(self, tag):
            if tag in html_extract._BLOCK:
                self.cut()

        def handle_data(self, data):
            now.append(data)

    reader = Reader(convert_charrefs=True)
    reader.feed(page)
    reader.close()
    reader.cut()
    return out


@pytest.mark.parametrize("seed", range(40))
def test_html_blocks_and_articles_of_generated_pages(seed):
    """The flat blocks are those of another reader, and the text is what the page was made around."""
    rnd = random.Random(seed)
    quote = lambda v: rnd.choice([f'"{v}"', f"'{v}'"])

    def sentence(n):
        return " ".join(rnd.choice(["word", "caf\u00e9", "a &amp; b", "&lt;i&gt;", "it's", "x=1", "long\n  er", "<b>bold</b>", f"<a href={quote('/l')}>link</a>", "end<br>line", "<i title='a > b'>em</i>"]) for _ in range(n))

    def element(tag, body, names=""):
        return f"<{tag}{names}>{body}" + ("" if tag == "p" and rnd.random() < 0.3 else f"</{tag}>")

    parts = [element(rnd.choice(["p", "h2", "li", "blockquote", "div"]), sentence(rnd.randint(12, 60))) for _ in range(rnd.randint(3, 9))]
    junk = [
        element("nav", "".join(element("li", f"<a href={quote('/' + str(i))}>Item {i}</a>") for i in range(4))),
        element("footer", sentence(6)),
        element("div", sentence(9), f" class={quote(rnd.choice(['ad-slot', 'cookieNotice', 'sidebar left', 'newsletter-signup', 'x widget']))}"),
        element("section", "".join(element("article", element("p", sentence(8))) for _ in range(3)), f" id={quote('comments')}"),
        element("aside", element("article", sentence(12))),
    ]
    rnd.shuffle(junk)
    k = rnd.randint(0, len(junk))
    wrapped = rnd.random() < 0.5
    inside = "<section>" + "".join(parts) + "</section>"
    body = element("article", inside, f" class={quote('post has-sidebar tag-social')}") if wrapped else element("div", inside, f" class={quote('page no-sidebar')}")
    page = "<html><body>" + "".join(junk[:k]) + body + "".join(junk[k:]) + "</body></html>"
    assert [b.text for b in html_extract.blocks(page)] == flat_blocks(page)
    if wrapped:
        assert html_extract.main_text(page).split("\n\n") == flat_blocks(inside)


def brute_licenses(text):
    """(number of standing notices, licence and coefficient of the heaviest), window by window."""
    w = re.sub("[^a-z0-9]+", " ", (text or "").lower()).split()
    pairs, best = list(zip(w, w[1:])), []
    for k, x in enumerate(license_scan.default_templates()):
        body = re.sub("[^a-z0-9]+", " ", x.text.lower()).split()
        known, found = set(zip(body, body[1:])), []
        for i in range(0, len(pairs), x.step):
            if x.step == 1 and pairs[i] not in known:
                continue
            for part in (0.8, 1, 1.25):
                n = max(1, round((len(body) - 1) * part))
                window = set(pairs[i : i + n])
                c, total = len(window & known), len(window) + len(known)
                if 10 * c >= 4 * total and set(x.required) <= set(w[i : i + n + 1]):
                    found.append((c * (2 * c * 10**9 // total), -k, -i, -n, i + n + 1, 2 * c * 10**9 // total / 1e9, x.license))
        best += found
    standing = []
    for x in sorted(best, key=lambda x: (-x[2], -x[0], -x[1], -x[3])):
        if not standing or -x[2] >= standing[-1][4]:
            standing.append(x)
        elif (x[0], x[1]) > standing[-1][:2]:
            standing[-1] = x
    top = max(standing, default=None)
    return len(standing), top and top[6], top and top[5]


def test_license_scan(spark, hard):
    rows = hard + [
        (30, "Licensed under CC BY 4.0."), (31, "Licensed under CC-BY-NC 4.0"), (32, "foo. licensed UNDER the apache license version 2.0! bar"), (33, "This work is licensed under the GNU General Public Licence, version 3."),
        (34, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License."), (35, "released under"), (35, "released under"), (36, "// SPDX-License-Identifier: MIT\nint x;"), (37, "SPDX-License-Identifier: Zlib"),
        (38, "This library is licensed under the GNU Lesser General Public License, version 2.1 or later."), (39, "Licensed under the Apache License, Version 1.1."), (40, "# SPDX-License-Identifier: GPL-2.0-only"),
        (41, " ".join(license_scan.license_texts()[5][2].split()[10:-5]) + " " + hard[0][1]), (42, "Released under the MIT License. " * 300), (43, (" ".join(hard[0][1].split()[:100]) + " Licensed under the MIT License. ") * 3),
        (44, "/* SPDX-License-Identifier: MIT OR Apache-2.0 */"), (45, "spdx-license-identifier: (GPL-2.0-only WITH Classpath-exception-2.0) AND BSD-3-Clause"),
    ]
    got = Counter((r.doc_id, r.n_notices, r.license, r.dice) for r in license_scan.scan_licenses(table(spark, rows)).collect())
    assert got == Counter((i, *brute_licenses(t)) for i, t in rows)
    told = {i: license for i, _, license, _ in got}
    every = {r.doc_id: (r.n_notices, r.licenses) for r in license_scan.scan_licenses(table(spark, rows)).collect()}
    assert every[42] == (300, "MIT") and every[43] == (3, "MIT")  # a notice that comes again counts again
    assert every[44] == (1, "Apache-2.0,MIT") and every[45][1] == "BSD-3-Clause,GPL-2.0" and every[37] == (0, None)
    assert [told[i] for i in (30, 31, 32, 33, 36, 37, 38, 39, 40)] == ["CC-BY-4.0", "CC-BY-NC-4.0", "Apache-2.0", "GPL-3.0", "MIT", None, "LGPL-2.1", None, "GPL-2.0"]
    assert license_scan.scan_licenses(table(spark, [])).count() == 0


def test_license_sql_agrees(spark, hard):
    import duckdb

    texts = [*(t for _, _, t in license_scan.license_texts()), "Licensed under CC BY 4.0. " + hard[0][1], "Licensed under the MIT License. " * 9 + "x\n// SPDX-License-Identifier: (MIT OR Apache-2.0+) AND Zlib", "a\nReleased under\nthe MIT\nLicense b"]
    rows = hard + [(100 + i, hard[i % 3][1] + "\n" + "\n".join(textwrap.wrap(t, 60))) for i, t in enumerate(texts)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    columns = ["doc_id", "n_notices", "licenses", "license", "dice", "template"]
    want = Counter(con.execute(f"SELECT {', '.join(columns)} FROM ({license_scan.license_sql()})").fetchall())
    assert Counter(tuple(r) for r in license_scan.scan_licenses(table(spark, rows)).select(*columns).collect()) == want


def test_license_passages(spark):
    whole = {(name, kind): text for name, kind, text in license_scan.license_texts()}
    get = lambda name, kind="whole text": whole[name, f"{name}, {kind}"]
    wrap = lambda text, width=60, mark="": "\n".join(mark + line for part in text.split("\n\n") for line in [*textwrap.wrap(part, width), ""])
    other = words_of(random.Random(3), 300)
    apache = wrap(get("Apache-2.0", "standard header"), 50, "# ")
    rows = [
        (1, wrap(get("MIT"))), (2, "MIT License Copyright (c) 2020 A. Author " + " ".join(get("MIT").split()) + " " + other), (3, other + "\n" + wrap(get("BSD-2-Clause"), mark=" * ")), (4, wrap(get("BSD-3-Clause"), 70, "// ")),
        (5, apache + "\nimport x\n" + other), (6, other + "\nReleased under\nthe MIT License\n" + other), (7, other + "\n" + get("GPL-3.0") + "\n" + other), (8, wrap(get("ISC")) + "\n\n" + other + "\n\n" + wrap(get("AGPL-3.0", "standard header"))),
        (9, other), (10, " ".join(get("MIT").split()[:60]) + " " + other), (11, None),
    ]
    got = {r.doc_id: r for r in license_scan.scan_licenses(table(spark, rows)).collect()}
    assert {i: r.license for i, r in got.items() if i not in (8,)} == {1: "MIT", 2: "MIT", 3: "BSD-2-Clause", 4: "BSD-3-Clause", 5: "Apache-2.0", 6: "MIT", 7: "GPL-3.0", 9: None, 10: "MIT", 11: None}
    assert got[8].license in ("ISC", "AGPL-3.0") and got[8].n_notices == 2
    assert [got[i].n_notices for i in (5, 6, 9, 11)] == [1, 1, 0, 0] and got[1].dice == got[3].dice == 1.0 and got[7].dice > 0.99


def brute_kneser_ney(rows, order):
    """By definition: counts of the highest order, numbers of different words before lower ones; the first word follows the start alone, by plain counts."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    tokens = {i: [x for x in re.split(SPACES, (t or "").translate(lower)) if x] + ["</s>"] for i, t in rows}
    train = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    one, plain, three = Counter(), Counter(), Counter()
    for i in train:
        one.update(tokens[i])
        plain.update(zip(["<s>", *tokens[i]], tokens[i]))
        three.update(zip(["<s>", *tokens[i]], tokens[i], tokens[i][1:]))
    two = plain if order == 2 else Counter({k: n for k, n in plain.items() if k[0] == "<s>"}) + Counter((v, w) for _, v, w in three)
    before = Counter(w for _, w in two)
    followers = defaultdict(list)
    for c in (two, three):
        for k, n in c.items():
            followers[k[:-1]].append(n)
    nn = lambda c: [sum(x == k for x in c) for k in (1, 2, 3, 4)]
    d3, d2, d1 = (ngram_lm.discounts(*nn(c.values())) for c in (three, two, before))
    n_all, v_all = sum(one.values()), len(one)

    def unigram(w):
        spread = sum(d1[min(n, 3) - 1] for n in before.values()) / len(two) if two else 1.0
        return (before[w] - (d1[min(before[w], 3) - 1] if before[w] else 0)) / max(1, len(two)) + spread / (v_all + 1)

    def step(counts, d, context, w, less):
        total = sum(followers[context])
        if not total:
            return less
        n = counts[*context, w]
        return (n - (d[min(n, 3) - 1] if n else 0)) / total + sum(d[min(x, 3) - 1] for x in followers[context]) / total * less

    def p(context, w):
        after_one = step(two, d2, context[-1:], w, unigram(w))
        return step(three, d3, context, w, after_one) if order == 3 and len(context) == 2 else after_one

    vocabulary = [*one, "never seen"]
    for context in [("<s>",), *((v,) for v in list(one)[:5]), ("unknown",), *(k[:-1] for k in list(three)[:5]), ("the", "the"), ("unknown", "the"), ("</s>", "unknown")]:
        assert math.isclose(sum(p(context, w) for w in vocabulary), 1, rel_tol=1e-9)
    out = {}
    for i, _ in rows:
        t = tokens[i]
        base = sum(math.log10((one[w] + 1) / (n_all + v_all + 1)) for w in t)
        score = sum(math.log10(p(tuple(["<s>", *t][max(0, at - 1) : at + 1]), w)) for at, w in enumerate(t))
        out[i] = (i not in train, len(t), sum(one[w] > 0 for w in t), n_all, base, score)
    return out


@pytest.mark.parametrize("order", [2, 3])
def test_ngram_model(spark, hard, monkeypatch, order):
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", 400)  # more shards than shuffle partitions
    rnd = random.Random(6)
    rows = [(i, t) for i, t in {i: t for i, t in hard if i is not None}.items()] + [(100 + i, words_of(rnd, rnd.randint(0, 60)) + " the" * 300 * (i % 3)) for i in range(60)]
    want = brute_kneser_ney(rows, order)
    got = ngram_lm.ngram_scores(table(spark, rows), order=order).collect()
    assert len(got) == len(want)
    for r in got:
        held, n, known, total, base, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)
    assert ngram_lm.ngram_scores(table(spark, []), order=order).count() == 0
    assert [r.score for r in ngram_lm.ngram_scores(table(spark, [(2, "a b")]).where(F.crc32(F.lit("2").cast("binary")) % 7 == 2)).collect()] in ([], [0.0])
    assert len(ngram_lm.ngram_scores(table(spark, [(None, "a b"), (None, "a b"), (1, None)])).collect()) == 3
