"""Operators against brute-force versions on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.llm import automaton, bpe, decontaminate, jaccard, jpeg, suffixes, warc
from quire.llm.common import scratch_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid string, digest int, words string, id int"


def rows_of(texts, first=0):
    return [(i + first, t, None if i % 3 else "en", "s", None if t is None else len(t), "u", 1, "w", 7) for i, t in enumerate(texts)]


def corpus(seed=1, n=60):
    """Random word texts with exact and near copies, shared passages and stutter."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 5))) for _ in range(300)] + ["A", "b.", "B."]
    text = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    base = [text(rng.randint(30, 220)) for _ in range(n)]
    passage = text(60)
    out = [*base, None, "", "   \t\n", "one", "one two three", passage, "x " * 300, "y z " * 90, text(4000)]
    for t in base[: n // 3]:
        w = t.split(" ")
        near = [x if rng.random() > 0.03 else "zz" for x in w]
        out += [t, " ".join(near), text(20) + "\n" + passage + "\n" + text(20), t.upper() if rng.random() < 0.3 else t + " " + text(3)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(corpus()), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_automaton(spark, docs, texts):
    words = {i: (t or "").encode().split() for i, t in texts.items()}
    seen = Counter(tuple(w[k : k + 35]) for w in words.values() for k in range(len(w) - 34))
    got = {r.doc_id: r for r in automaton.remove_repeats(docs, with_text=True).collect()}
    assert len(got) == len(texts)
    removed = 0
    for i, w in words.items():
        gone = [any(seen[tuple(w[s : s + 35])] > 1 for s in range(max(0, k - 34), min(k, len(w) - 35) + 1)) for k in range(len(w))]
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        removed += sum(gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept) == (len(w), sum(gone), kept.decode())
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert removed > 1000
    assert automaton.remove_repeats(empty(spark)).count() == 0


def test_automaton_of_two_sequences():
    a = automaton.Automaton(3)
    a.add([*"abcab"], 2)
    a.add([*"bcabx"], 1)
    a.settle()
    assert a.repeated([*"abcab"], 2) == [0, 1, 2]
    assert a.repeated([*"abcab"], 3) == [1, 2]
    assert a.repeated([*"zabx"], 1) == [1]


def test_repeated_rows_lose_all_and_null_ids_are_kept(spark):
    t = " ".join(str(i) for i in range(40))
    own = spark.createDataFrame([(1, t), (1, t), (None, t), (None, None)], "doc_id long, text string")
    assert sorted((r.n_words, r.n_removed) for r in automaton.remove_repeats(own).collect()) == [(0, 0), (40, 40), (40, 40), (40, 40)]


def first_places(words, n):
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - n + 1):
            first.setdefault(tuple(words[i][k : k + n]), (i, k))
    return first


def test_suffixes(spark, docs, texts):
    words = {i: (t or "").encode().split() for i, t in texts.items()}
    first = first_places(words, 50)
    want = {(i, k + d) for i, w in words.items() for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] != (i, k) for d in range(50)}
    rows = suffixes.removed_passages(docs).collect()
    assert {(r.doc_id, k) for r in rows for k in range(r.start_word, r.start_word + r.n_words)} == want and want
    out = suffixes.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    for r in out.collect():
        kept = [w for k, w in enumerate(words[r.doc_id]) if (r.doc_id, k) not in want]
        assert (r.text or "").encode().split() == kept and (r.text is None) == (texts[r.doc_id] is None)
        if len(kept) == len(words[r.doc_id]):
            assert r.text == texts[r.doc_id]
    assert suffixes.removed_passages(empty(spark)).count() == suffixes.without_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("chunk", [2, 1000])
def test_shards_of_a_hot_anchor(spark, monkeypatch, chunk):
    """Many different spans about one anchor, dealt to shards of two classes, give the same as one shard."""
    from quire.llm import passages

    monkeypatch.setattr(passages, "CHUNK", chunk)
    rng = random.Random(5)
    core = [f"c{i}" for i in range(55)]
    own = {}
    for i in range(40):
        w = [f"l{rng.randint(0, 2)}" for _ in range(4)] + core + [f"r{rng.randint(0, 2)}" for _ in range(4)]
        w[rng.randint(0, 62)] = "edit"
        own[i] = w
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in own.items()], "doc_id long, text string")
    first = first_places(own, 50)
    want = {(i, k + d) for i, w in own.items() for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] != (i, k) for d in range(50)}
    assert {(r.doc_id, k) for r in suffixes.removed_passages(frame).collect() for k in range(r.start_word, r.start_word + r.n_words)} == want
    seen = Counter(tuple(w[k : k + 35]) for w in own.values() for k in range(len(w) - 34))
    covered = {i: len({k + d for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for d in range(35)}) for i, w in own.items()}
    assert {r.doc_id: r.n_removed for r in automaton.remove_repeats(frame).collect()} == covered


@pytest.mark.parametrize("kind", ["smallint", "string", "decimal(10,0)", "date"])
def test_ids_of_other_types(spark, kind):
    t = " ".join(f"w{i}" for i in range(60))
    own = spark.createDataFrame([(1, t), (2, f"x {t}"), (3, "a b c"), (None, t)], "doc_id int, text string")
    own = own.withColumn("doc_id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("doc_id")) if kind == "date" else F.col("doc_id").cast(kind))
    assert automaton.remove_repeats(own).where("n_removed >= 60").count() == 3
    rows = suffixes.removed_passages(own).collect()
    assert len(rows) == 2 and all(r.first_doc_id is None for r in rows)  # a row without an id comes before all others
    items = own.where("doc_id is not null").select(F.col("doc_id").alias("item_id"), "text")
    assert decontaminate.contaminated(own, items).count() >= 4 and jaccard.join(own).count() == 4


def shingles(text):
    w = WORD.findall((text or "").translate({65 + i: 97 + i for i in range(26)}))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def components(sets):
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sorted(sets):
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


@pytest.mark.parametrize(("small", "chunk"), [(16, 4096), (2, 5)])
def test_jaccard(spark, docs, texts, monkeypatch, small, chunk):
    """Also with blocks that count as large, and are dealt by pairs of chunks, from three and six classes on."""
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    sets = {i: shingles(t) for i, t in texts.items()}
    want = components(sets)
    got = {r.doc_id: r for r in jaccard.join(docs).collect()}
    assert {i: (len(s), want[i]) for i, s in sets.items()} == {i: (r.n_shingles, r.component_id) for i, r in got.items()}
    assert sum(want[i] != i for i in want) > 20
    kept = jaccard.representatives(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i in want if want[i] == i)


def test_jaccard_edges(spark):
    assert jaccard.join(empty(spark)).count() == 0
    own = spark.createDataFrame([(3, "a b c d e f"), (1, "A B C d e f"), (None, "a b c d e f"), (4, None), (5, ""), (2, "a b"), (6, "a b"), (7, "a b c")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.join(own).collect())
    assert got == [(0, 2, 1), (1, 2, 1), (2, 1, 2), (3, 2, 1), (4, 0, 4), (5, 0, 5), (6, 1, 2), (7, 1, 7)]
    twice = own.union(own).union(spark.createDataFrame([(7, "other words entirely"), (None, "no id here"), (None, None)], own.schema))
    kept = sorted((r.doc_id or 0, r.text or "") for r in jaccard.representatives(twice).collect())
    assert kept == [(0, ""), (0, "no id here"), (1, "A B C d e f"), (2, "a b"), (4, ""), (5, ""), (7, "a b c"), (7, "other words entirely")]


def test_group_counts_bound_the_overlap():
    """Folded or not, packed counts never bound an overlap too low, and they tell unrelated long sets apart."""
    import numpy as np

    rng = np.random.default_rng(3)
    for n, m, common in [(1, 1, 1), (5, 6, 4), (200, 260, 180), (3000, 2500, 1000), (3000, 3900, 2900), (40_000, 30_000, 0)]:
        both = rng.integers(0, 1 << 63, common, dtype=np.uint64) * np.uint64(2)
        a, b = (np.sort(np.concatenate([both, rng.integers(0, 1 << 63, k - common, dtype=np.uint64) * np.uint64(2) + np.uint64(1)])) for k in (n, m))
        points = [jaccard.point(x) for x in (a, b)]
        packed = [np.frombuffer(p, np.uint8) for p, _ in points]
        assert sum(s for _, s in points) + int(jaccard.smaller(packed[0][None], packed[1])[0]) >= common
        assert [int(jaccard.folded(p, jaccard.COARSE).sum()) for p in packed] == [n - points[0][1], m - points[1][1]]
    assert 175 * int(jaccard.smaller(packed[0][None], packed[1])[0]) < 75 * (n + m)
    same = np.full(90, 7, np.uint64)  # all in one group, which holds 15
    p, s = jaccard.point(same)
    assert s == 75 and int(jaccard.smaller(np.frombuffer(p, np.uint8)[None], np.frombuffer(p, np.uint8))[0]) == 15


def test_components_of_a_path(spark):
    from quire.llm.links import components as found

    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 50), (60, 61), (61, 60)], "a long, b long")
    got = {r.node: r.component for r in found(edges).collect()}
    assert got == dict.fromkeys(range(41), 0) | {60: 60, 61: 60}


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_bpe_agrees_with_the_library(spark):
    from tokenizers import Tokenizer

    lib, own = Tokenizer.from_file(tokenizer()), bpe.ChunkCodec(tokenizer(), chunk_bytes=200_000)
    rng = random.Random(2)
    parts = [" ", "  ", "a", "bc ", "\n", "'s", "é", "9", "!!", "<|endoftext|>", "日本", "\t", "👩‍👩‍👧", "\x1c", "\x00", " ", "​", "ﬁ", "İ"]
    texts = ["", " ", "x" * 3000, "\r\n\t a" * 500, " <|endoftext|> a <|endoftext|>b"] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 1500))) for _ in range(120)] + [t for t in corpus() if t]
    for t in texts * 2:
        want = lib.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == want and own.decode(want) == lib.decode(want, skip_special_tokens=False)
    frame = spark.createDataFrame(rows_of([None, *texts]), SCHEMA)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in bpe.encode_documents(frame, tokenizer(), with_ids=True).collect():
        t = ([None, *texts])[r.doc_id] or ""
        want = lib.encode(t, add_special_tokens=False).ids
        assert (r.n_tokens, r.token_ids, r.ids_sha256, r.decoded_sha256) == (len(want), want, sha(",".join(map(str, want))), sha(t))
    assert bpe.encode_documents(empty(spark), tokenizer()).count() == 0


def test_bpe_joins_are_repaired_or_given_up(monkeypatch):
    """Joins agree with a wider window; a fault in one shows, and the text goes to the library as a whole."""
    from tokenizers import Tokenizer

    lib, own = Tokenizer.from_file(tokenizer()), bpe.ChunkCodec(tokenizer())
    text = " ".join(f"word{i} und mehr, davon" for i in range(400))
    whole = lambda t: lib.encode(t, add_special_tokens=False).ids
    asked = []
    monkeypatch.setattr(own, "library", lambda t: asked.append(t) or whole(t))
    assert own.encode(text) == whole(text) and not asked and len(own.new) > 5
    taken = len(own.new)
    assert own.encode("Vorher steht anderes. " + text) == whole("Vorher steht anderes. " + text) and len(own.new) <= taken + 3
    for k, (head, core, tail, opening, first, closing, ending) in list(own.new.items()):
        own.new[k] = (head, core, tail, opening, [0, *first], closing, ending)
    assert own.encode(text) == whole(text) and asked == [text]


def test_chunks_depend_on_content():
    import numpy as np

    rng = random.Random(4)
    a, b, c = (bytes(rng.randrange(32, 127) for _ in range(5000)) for _ in range(3))
    ends = lambda x: set(bpe.chunk_ends(np.frombuffer(x, np.uint8))[1])
    inner = {e for e in ends(b) if e > 16}
    assert inner and {e + len(a) for e in inner} <= ends(a + b) and {e + len(c) for e in inner if e < 4000} <= ends(c + b)


def test_jpeg_round_trip(spark, docs, texts):
    got = {r.doc_id: r for r in jpeg.read_media(jpeg.write_media(docs, "doc_id", "text"), "doc_id").collect()}
    assert len(got) == len(texts)
    for i, t in texts.items():
        b = (t or "").encode()
        p = b + bytes(-len(b) % 64 or (64 if not b else 0))
        assert (got[i].n_bytes, got[i].payload_bytes, got[i].payload_sha256, got[i].tail_crc32) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
    one = [i for i, t in texts.items() if t == texts[0]]
    assert len(one) > 1 and len({(got[i].media_sha256, got[i].feature) for i in one}) == 1
    assert jpeg.read_media(jpeg.write_media(empty(spark), "doc_id", "text"), "doc_id").count() == 0


def test_jpeg_of_any_bytes_and_no_image(spark):
    rng = random.Random(6)
    own = spark.createDataFrame([(i, bytearray(rng.randbytes(n))) for i, n in enumerate([0, 1, 64, 65, 5000])] + [(9, bytearray(b"\xff" * 400))], "k long, b binary")
    back = {r.k: r for r in jpeg.read_media(jpeg.write_media(own, "k", "b"), "k").collect()}
    assert {r.k: len(r.b) for r in own.collect()} == {k: r.n_bytes for k, r in back.items()}
    broken = spark.createDataFrame([(1, None), (2, bytearray(b"")), (3, bytearray(b"\xff\xd8\xff\xe0")), (4, bytearray(b"GIF89a"))], "k long, media binary")
    assert all(r.error and r.feature is None and r.payload_bytes is None for r in jpeg.read_media(broken, "k").collect())


def colour_image():
    """16 x 16, 4:2:0: four luminance blocks, Cb and Cr, with zero runs, DC steps and no restart intervals."""
    lengths = {0x00: 2, 0x01: 2, 0x02: 3, 0x11: 3, 0xF0: 4, 0x31: 5}
    codes = jpeg.canonical(lengths)
    dc = jpeg.canonical({s: 4 for s in range(9)})
    bits = ""

    def put(table, symbol, value=0, size=0):
        nonlocal bits
        code, n = table[symbol]
        bits += f"{code:0{n}b}" + (f"{value if value >= 0 else value + (1 << size) - 1:0{size}b}" if size else "")

    means = [80, -40, 0, 120, 5, -5]
    before = {0: 0, 1: 0, 2: 0}
    for i, mean in enumerate(means):
        part = max(0, i - 3)
        step = mean - before[part]
        before[part] = mean
        put(dc, abs(step).bit_length(), step, abs(step).bit_length())
        put(codes, 0x31, -1, 1)  # three zeros, then -1 at place 4
        put(codes, 0xF0)  # sixteen zeros
        put(codes, 0x02, 3, 2)
        put(codes, 0x00)
    bits += "1" * (-len(bits) % 8)
    scan = bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")
    frame = bytes([8, 0, 16, 0, 16, 3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    quant = jpeg.segment(0xDB, bytes([0, *[8] * 64]))
    tables = jpeg.segment(0xC4, jpeg.huffman_segment(0x00, {s: 4 for s in range(9)})) + jpeg.segment(0xC4, jpeg.huffman_segment(0x10, lengths))
    return b"\xff\xd8" + quant + tables + jpeg.segment(0xC0, frame) + jpeg.segment(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 63, 0])) + scan + b"\xff\xd9"


def test_jpeg_colour_with_sampling():
    raw = colour_image()
    (got,) = jpeg.read_images([raw])
    assert (got["width"], got["height"]) == (16, 16)
    assert got["thumbnail"].tolist() == [[208, 88], [128, 248]]
    im = jpeg.Image(raw)
    (c,) = jpeg.decode_scans([im])
    assert c[:, 0].tolist() == [80, -40, 0, 120, 5, -5] and c[:, 4].tolist() == [-1] * 6 and c[:, 21].tolist() == [3] * 6
    assert (c != 0).sum() == 17
    assert isinstance(jpeg.read_images([raw.replace(b"\xff\xc0", b"\xff\xc2", 1)])[0], str)


PAGES = "page_id long, url string, html string, digest string, payload string, n int"


def test_warc(spark):
    rng = random.Random(8)
    html = ["<p>a</p>", "<p>a</p>", None, "", "WARC/1.1\r\nx\r\n\r\ny", "é\r\n\r\nz", "same\n"] + [f"<b>{rng.random()}</b>" * rng.randint(1, 50) for _ in range(30)] + ["same\n"] * 5
    rows = [(i, None if i == 3 else f"http://x/{i}", h, "d", "p", 1) for i, h in enumerate(html)] + [(0, "http://x/0", "<p>a</p>", "d", "p", 1), (None, "u", "alone", "d", "p", 1), (None, "u", "same\n", "d", "p", 1)]
    path = scratch_dir(spark, "test-warc")
    warc.write_archives(warc.with_revisits(spark.createDataFrame(rows, PAGES).repartition(3)), path, file_bytes=2000)
    back = warc.read_archives(spark, path)
    assert back.where("kind <> 'record'").count() == 0
    largest = {}
    for i, _, h, *_ in rows:
        largest[h or ""] = max(-1 if i is None else i, largest.get(h or "", -1))
    want = []
    for i, _, h, *_ in rows:
        b, top = (h or "").encode(), largest[h or ""]
        response = i == top or top == -1
        want.append((str(i), len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if response else "revisit", str(None if response else top)))
    assert sorted(want) == sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in back.collect())
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    assert len(files) > 5 and all(gzip.decompress(f).startswith(b"WARC/1.1") for f in files)  # any reader of gzip takes them
    assert sum(len(list(warc.salvage(f))) for f in files) == len(rows)
    nothing = scratch_dir(spark, "test-warc")
    warc.write_archives(warc.with_revisits(spark.createDataFrame([], PAGES)), nothing)
    assert warc.read_archives(spark, nothing).count() == 0


def test_warc_of_its_own_archives_is_salvaged(spark):
    """One byte flipped anywhere costs one record; very long payloads and extra columns do no harm."""
    rng = random.Random(10)
    rows = [(i, f"http://x/{i}", "".join(rng.choice("abcdef <>") for _ in range(rng.randint(1, 900))), "d", "p", 1) for i in range(200)] + [(200, "u", "long " * 4_000_000, "d", "p", 1)]
    path = scratch_dir(spark, "test-warc")
    warc.write_archives(warc.with_revisits(spark.createDataFrame(rows, PAGES).coalesce(1)), path)
    (whole,) = [f for f in (bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()) if f]
    ids = lambda data: {int(x[3]["warc-record-id"].rsplit(":", 1)[1][:-1]) for x in warc.salvage(data) if x[0] == "record"}
    assert ids(whole) == set(range(201))
    for _ in range(40):
        at = rng.randrange(len(whole))
        bad = whole[:at] + bytes([whole[at] ^ 0x10]) + whole[at + 1 :]
        found = list(warc.salvage(bad))
        assert len(ids(bad)) >= 200
        if len(ids(bad)) < 201:
            assert any(x[0] == "gap" and x[-1] is None and x[1] <= at < x[2] or x[0] == "gap" and x[-1] is not None for x in found)


def record(i, payload):
    head = f"HTTP/1.1 200 OK\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload
    digest = lambda x: base64.b32encode(hashlib.sha1(x).digest()).decode()
    return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <{warc.URN}{i}>\r\nWARC-Payload-Digest: sha1:{digest(payload)}\r\nWARC-Block-Digest: sha1:{digest(block)}\r\nContent-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("zipped", [False, True])
def test_warc_salvage(zipped):
    rng = random.Random(9)
    made = [record(i, f"payload {i} ".encode() * rng.randint(1, 90) + b"WARC/1.1\r\n") for i in range(12)]
    made = [gzip.compress(m) for m in made] if zipped else made
    edges = [0]
    for m in made:
        edges.append(edges[-1] + len(m))
    whole = b"".join(made)
    ids = lambda data: [x[3]["warc-record-id"].rsplit(":", 1)[1][:-1] for x in warc.salvage(data) if x[0] == "record"]
    assert ids(whole) == [str(i) for i in range(12)]
    for hurt in range(12):
        for _ in range(4):
            at = rng.randrange(edges[hurt] + 4, edges[hurt + 1] - (0 if zipped else 4))
            bad = whole[:at] + bytes([whole[at] ^ 0x55]) + whole[at + 1 :]
            found = list(warc.salvage(bad))
            got = [x[3]["warc-record-id"].rsplit(":", 1)[1][:-1] for x in found if x[0] == "record"]
            assert set(got) >= {str(i) for i in range(12) if i != hurt}
            cut = whole[:at] + whole[min(at + 9, edges[hurt + 1]) :]
            assert set(ids(cut)) >= {str(i) for i in range(12) if i != hurt}
    gaps = [x for x in warc.salvage(whole[: edges[3]] + b"garbage" + whole[edges[3] :]) if x[0] == "gap"]
    assert [(g[1], g[2]) for g in gaps] == [(edges[3], edges[3] + 7)]
    assert list(warc.salvage(b"")) == [] and [x[0] for x in warc.salvage(b"nothing")] == ["gap"]


def best_alignment(doc, item):
    line, best = [0] * (len(item) + 1), 0
    for w in doc:
        new = [0]
        for j, v in enumerate(item):
            new.append(max(0, line[j] + (2 if v == w else -1), line[j + 1] - 1, new[j] - 1))
        line = new
        best = max(best, *line)
    return best


def test_decontaminate(spark):
    rng = random.Random(12)
    vocab = [f"w{i}" for i in range(400)] + ["the", "of"] * 40
    text = lambda k: [rng.choice(vocab) for _ in range(k)]
    items = [text(rng.randint(15, 50)) for _ in range(25)]
    docs = [text(rng.randint(20, 300)) for _ in range(120)]
    for i, item in enumerate(items):
        hurt = [x if rng.random() > 0.02 * (i % 10) else rng.choice(vocab) for x in item]
        at = rng.randint(0, len(docs[i]))
        docs[i] = docs[i][:at] + [w.title() + rng.choice(["", ",", "."]) for w in hurt] + docs[i][at:]
    rows = rows_of([" ".join(d) for d in docs] + [None, "", "w1", " ".join(items[0]) + " " + " ".join(items[0])])
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(90, None), (91, ""), (92, "w1 zz"), (93, " ".join(items[2]))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(spark.createDataFrame(rows, SCHEMA), bench).collect()}
    plain = [re.sub(r"[.,]", "", r[1] or "").lower().split() for r in rows]
    want = {}
    for d, w in enumerate(plain):
        for i, item in [*enumerate(items), (93, items[2])]:
            if w and (s := best_alignment(w, item) / (2 * len(item))) >= 0.4:
                want[d, i] = s
    assert {k: round(r.score, 9) for k, r in got.items()} == {k: round(s, 9) for k, s in want.items()}
    assert all((i, i) in got for i in range(25)) and (123, 0) in got
    assert got[123, 0].start_word == 0 and got[123, 0].n_words == len(items[0])
    assert decontaminate.contaminated(empty(spark), bench).count() == 0
    assert decontaminate.contaminated(spark.createDataFrame(rows, SCHEMA), bench.where("false")).count() == 0


@pytest.mark.parametrize("copies", [50, 1000])
def test_decontaminate_leaks_in_many_documents(spark, copies):
    item = [f"q{i}" for i in range(30)]
    edited = [w if k % 5 < 4 else f"e{k}" for k, w in enumerate(item)]
    half = [f"h{i}" for i in range(31)]
    texts = [f"a{i} b{i} {' '.join(edited)} c{i}" for i in range(copies)] + [f"a{i} {' '.join(half[:14])} d{i} e{i}" for i in range(copies)] + ["clean text q1 h1"]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(half))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.score, 9) for r in decontaminate.contaminated(spark.createDataFrame(rows_of(texts), SCHEMA), bench).collect()}
    scores = [round(best_alignment(edited, item) / 60, 9), round(best_alignment(half[:14], half) / 62, 9)]
    assert got == {(i, 1 if i < copies else 2): scores[i >= copies] for i in range(2 * copies)}


def test_decontaminate_sends_texts_once(spark):
    """Letters of all scripts lose their capitals, and no text is sent to Python a second time as its own lower-case copy."""
    items = ["Zwölf ÄPFEL lagen unter dem BAUM und keiner wollte sie", "ΟΔΟΣ ΚΑΙ ΛΟΓΟΣ στην ΑΡΧΗ του Ἔργου λέξη ἘΝ τέλει", "Twelve APPLES lay below the tree and none wanted them"]
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    texts = [f"vorher {t} danach" for x in items for t in (x, x.upper(), x.lower())] + [None, "", "Éin anderer Text", "ANOTHER text"]
    rows = spark.createDataFrame(rows_of(texts), SCHEMA)
    assert {(r.doc_id, r.item_id, r.score) for r in decontaminate.contaminated(rows, bench).collect()} == {(i, i // 3, 1.0) for i in range(9)}
    assert {r.doc_id: r.text for r in decontaminate.without_contaminated(rows, bench).collect()} == {i: texts[i] for i in range(9, 13)}
    plain = spark.createDataFrame([(i, f"SOME Wörter number {i} " * 50) for i in range(64)], "doc_id long, text string")
    sent = decontaminate.without_contaminated(plain, bench)
    assert sent.count() == 64
    sent.collect()
    jvm = sent._jdf.queryExecution().executedPlan()
    stack, moved = [jvm], 0
    while stack:
        node = stack.pop()
        kids = node.children()
        stack += [kids.apply(i) for i in range(kids.size())]
        if node.nodeName() == "MapInArrow":
            moved += node.metrics().apply("pythonDataSent").value()
    size = sum(len((f"SOME Wörter number {i} " * 50).encode()) for i in range(64))
    assert size < moved < 1.5 * size
