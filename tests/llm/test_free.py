"""Token counts, sharding, media columns, the Jaccard join and BPE against brute force and exact round trips."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
import xxhash

from ledgerlens.llm import bpe, media, ngram_jaccard, queries, sharding, token_counts
from ledgerlens.llm.common import shared_dir

DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, digest string, n long, sig string, near string, shard int, media string"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "abc def " * 30000), (6, "é ñ 漢字 🙂 <|endoftext|> don't"), (6, "é ñ 漢字 🙂 <|endoftext|> don't"), (7, "x" * 5000), (8, "ab  \n\n  cd" * 400), (9, "\x00\x85\u3000tab\t")]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "x", 5, "y", "z", 1, "m") for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary())


def corpus(spark):
    rows = queries.table(spark, DIR, "documents").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows]


def test_token_counts(spark, library):
    texts = ODD + [(None, "null id")] + corpus(spark)
    cache = shared_dir(spark)
    for part in (texts[:20], texts, []):  # the second call finds some counts, the third needs none
        got = token_counts.count_tokens(docs(spark, part), queries.vocabulary(), cache).collect()
        want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in part]
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    kept = token_counts.stored(spark, cache, token_counts.tokenizer_version(queries.vocabulary()))
    assert kept.count() == kept.select("digest").distinct().count() == len({t or "" for _, t in texts})


def test_bpe(spark, library):
    shared = " ".join(random.Random(5).choice(["alpha", "beta", "gamma", "delta,", "eps\n"]) for _ in range(3000))
    texts = ODD + [(20, "start " + shared), (21, shared + " end"), (22, "mid " + shared[7000:] + "  \n" + shared)] + corpus(spark)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    got = bpe.round_trip(docs(spark, texts), queries.vocabulary()).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    back = bpe.decode(bpe.encode(docs(spark, texts), queries.vocabulary()), queries.vocabulary()).collect()
    assert sorted((r["doc_id"], r["text"]) for r in back) == sorted((i, t or "") for i, t in texts)
    assert bpe.round_trip(docs(spark, []), queries.vocabulary()).count() == 0


def test_chunks_are_reused():
    e = bpe.Encoder(queries.vocabulary())
    shared = " ".join(random.Random(9).choice(["alpha", "beta", "gamma", "delta,", "eps"]) + str(k) for k in range(4000))
    e.ids("one " + shared)
    before = e.encoded
    e.ids("another start of a text " + shared)
    assert e.encoded - before <= 2 and e.reused >= 5


@pytest.mark.parametrize("letters", ["абвгдежзийклмнопрст ", "的一是不了人我在有他这中大来上国", "abcdefghij0123456789", "あいうえおかきくけこ漢字", "אבגדהו ", "कखगघङचछजािीु "])
def test_chunks_of_any_script(library, letters):
    """A body that five texts share is encoded about once, in any script and without blanks too."""
    rng, e = random.Random(letters), bpe.Encoder(queries.vocabulary())
    body = "".join(rng.choice(letters) for _ in range(40_000))
    texts = [f"{''.join(rng.choice(letters) for _ in range(50 + 31 * k))}{body}{''.join(rng.choice(letters) for _ in range(700))}" for k in range(5)]
    for t in texts:
        assert e.ids(t) == library.encode(t, add_special_tokens=False).ids
    assert e.reused > 1.5 * e.encoded


def test_specials_at_inner_cuts(library, monkeypatch):
    """Special strings and short forms near cuts in text without blanks."""
    cuts = bpe.cuts
    monkeypatch.setattr(bpe, "cuts", lambda data: cuts(data, bits=4, least=16))
    monkeypatch.setattr(bpe, "INNER_POINTS", 2)
    monkeypatch.setattr(bpe, "NEAR", 64)
    rng, e = random.Random(5), bpe.Encoder(queries.vocabulary())
    parts = ["абв", "слово", "漢字", "word", "'ve", "'s", "<|endoftext|>", "123", "é", "。", "x", "endoftext", "\u00a0", "|>", "<|"]
    for k in range(150):
        few = rng.sample(parts, 2 + k % 12)
        t = "".join(rng.choice(few) for _ in range(rng.randrange(100, 900)))
        assert e.ids(t) == library.encode(t, add_special_tokens=False).ids
    assert e.reused > 50


def test_repairs_any_text(library):
    rng, e = random.Random(11), bpe.Encoder(queries.vocabulary())
    parts = ["word", " ", "\n", "  ", "'s", "'ll", "é", "12", "!?", "<|endoftext|>", "\t", " x", "ZZZ", "\u00a0", "漢"]
    for _ in range(60):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(500, 4000)))
        assert e.ids(t) == library.encode(t, add_special_tokens=False).ids


def test_repair_widens_until_exact(library, monkeypatch):
    """Where the points that pass for safe are not, windows grow or joins are given up, and tokens stay exact."""
    import re

    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abcdelnrst") for _ in range(rng.randrange(1, 30))) for _ in range(700)) for _ in range(6)]
    made = []
    for unsafe in (rb"(?<=[a-z])(?=[a-z])", rb"(?<=[a-z ])(?=[a-f])", rb"(?=[ a])"):
        monkeypatch.setattr(bpe, "SAFE", re.compile(unsafe))
        e = bpe.Encoder(queries.vocabulary())
        for t in texts:
            assert e.ids(t) == library.encode(t, add_special_tokens=False).ids
            made.append(len(e.pieces(t)))
    assert max(made) > 1  # some joins agree even so


def test_other_tokenizer_files(tmp_path):
    """A file without the plain byte-level form goes through the library alone, both ways."""
    import json

    from tokenizers import Tokenizer

    with open(queries.vocabulary()) as f:
        spec = json.load(f)
    assert bpe.Codec(queries.vocabulary()).plain
    swapped = spec["model"]["merges"][:]
    swapped[300], swapped[301] = swapped[301], swapped[300]
    for k, other in enumerate([spec | {"pre_tokenizer": None, "decoder": spec.get("decoder")}, spec | {"model": spec["model"] | {"merges": swapped}}]):
        path = tmp_path / f"{k}.json"
        path.write_text(json.dumps(other))
        c, lib = bpe.Codec(str(path)), Tokenizer.from_file(str(path))
        text = "plainwords" * 200
        assert not c.plain and bpe.Encoder(str(path)).ids(text) == lib.encode(text, add_special_tokens=False).ids
        assert c.decode_bytes(c.encode(text)).decode() == lib.decode(lib.encode(text, add_special_tokens=False).ids, skip_special_tokens=False)


def shard_by_hand(key, tree):
    def draw(level, name, weight):
        h = xxhash.xxh64_intdigest(f"{key}|{level}|{name}".encode(), 42)
        return -math.log(((h >> 11) + 0.5) / 2**53) / weight

    for level, attribute in (("region", "region"), ("rack", "rack"), ("shard", "number")):
        names = sorted({str(getattr(s, attribute)) for s in tree})
        if len(names) > 1:
            best = min(names, key=lambda n: draw(level, n, sum(s.weight for s in tree if str(getattr(s, attribute)) == n)))
            tree = [s for s in tree if str(getattr(s, attribute)) == best]
    return tree[0].number


def test_sharding(spark):
    texts = ODD + [(1, None)] * 3 + [(None, "null")] + [(k, f"text {k}") for k in range(100, 900)]
    tree = sharding.regular_tree()
    got = sharding.assign(docs(spark, texts), rows_per_bucket=7).collect()
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", shard_by_hand("null" if i is None else i, tree), shard_by_hand("null" if i is None else i, sharding.grown(tree))) for i, t in texts]
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in got), key=repr) == sorted(want, key=repr)
    for shard in range(16):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 16) for r in got)
    counts = [sum(r["shard"] == s for r in got) for s in range(16)]
    assert min(counts) > 20 and max(counts) < 100
    assert sharding.assign(docs(spark, [])).count() == 0


def test_changed_weight_stays_below_it(spark):
    tree = sharding.regular_tree()
    heavier = tuple(sharding.Shard(s.region, s.rack, s.number, 2.0 if s.number == 5 else 1.0) for s in tree)
    d = docs(spark, [(k, "t") for k in range(2000)])
    a, b = ({r["doc_id"]: r["shard"] for r in sharding.assign(d, t).collect()} for t in (tree, heavier))
    region = {s.number: s.region for s in tree}
    moved = [(a[k], b[k]) for k in a if a[k] != b[k]]
    assert moved and all(region[y] == region[5] for _, y in moved)


def test_stored_texts(spark):
    texts = ODD + [(None, "null id"), (30, "x" * 64), (31, "x" * 65)]
    got = {}
    for r in media.stored_texts(docs(spark, texts)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, t in texts:
        data = (t or "").encode()
        payload = data + bytes(-len(data) % 64 or 64 * (not data))
        for r in got[i]:
            assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
            stored = media.pack(payload)
            assert (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())
    assert len(got[6]) == 2 and got[6][0]["feature"] == got[6][1]["feature"]
    assert media.stored_texts(docs(spark, [])).count() == 0


class Writer:
    """A plain encoder of progressive scans, code by code, with one table of eight-bit codes for all symbols."""

    counts, symbols = bytes([0] * 8 + [255] + [0] * 7), bytes(range(255))

    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits += [value >> i & 1 for i in range(n)][::-1]

    def code(self, symbol):
        self.put(symbol, 9)

    def value(self, v):
        n = abs(v).bit_length()
        self.put(v if v >= 0 else v + (1 << n) - 1, n)

    def data(self):
        out = np.packbits(np.array(self.bits + [1] * (-len(self.bits) % 8), np.uint8)).tobytes()
        self.bits = []
        return out.replace(b"\xff", b"\xff\x00")

    def runs(self, n):
        size = n.bit_length() - 1
        self.code(size << 4)
        self.put(n - (1 << size), size)


def shifted(v, low):
    return (abs(v) >> low) * (1 if v >= 0 else -1)


def ac_first(w, blocks, first, last, low):
    waiting = 0
    for block in blocks:
        run, k = 0, first
        for k in range(first, last + 1):
            v = shifted(int(block[k]), low)
            if not v:
                run += 1
                continue
            if waiting:
                w.runs(waiting)
                waiting = 0
            while run > 15:
                w.code(0xF0)
                run -= 16
            w.code(run << 4 | abs(v).bit_length())
            w.value(v)
            run = 0
        if run:
            waiting += 1
    if waiting:
        w.runs(waiting)
    return w.data()


def ac_refine(w, blocks, first, last, low):
    waiting, held = 0, []

    def flush():
        nonlocal waiting, held
        if waiting:
            w.runs(waiting)
            w.bits += held
            waiting, held = 0, []

    for block in blocks:
        a = [abs(int(block[k])) >> low for k in range(64)]
        end = max((k for k in range(first, last + 1) if a[k] == 1), default=-1)
        run, fixes = 0, []
        for k in range(first, last + 1):
            if a[k] == 0:
                run += 1
                continue
            while run > 15 and k <= end:
                flush()
                w.code(0xF0)
                run -= 16
                w.bits += fixes
                fixes = []
            if a[k] > 1:
                fixes.append(a[k] & 1)
                continue
            flush()
            w.code(run << 4 | 1)
            w.put(int(block[k] >= 0), 1)
            w.bits += fixes
            run, fixes = 0, []
        if run or fixes:
            waiting += 1
            held += fixes
    flush()
    return w.data()


@pytest.mark.parametrize("width,height,colour", [(13, 21, False), (40, 24, True), (17, 33, True)])
def test_general_decoder(width, height, colour):
    rng, w, seg = np.random.default_rng(width), Writer(), media._segment
    shape = [(1, 2, 2), (2, 1, 1), (3, 1, 1)] if colour else [(1, 1, 1)]
    unit = 16 if colour else 8
    across, down = -(-width // unit), -(-height // unit)
    planes = {i: np.where(rng.random((down * v, across * h, 64)) < 0.2, rng.integers(-60, 61, (down * v, across * h, 64)), 0) for i, h, v in shape}
    for p in planes.values():
        p[:, :, 0] = rng.integers(-500, 500, p.shape[:2])
    out = [b"\xff\xd8", seg(0xDB, b"\0" + bytes([3] * 64)), seg(0xC2, bytes([8, 0, height, 0, width, len(shape)]) + b"".join(bytes([i, h << 4 | v, 0]) for i, h, v in shape))]
    out += [seg(0xC4, b"\x00" + w.counts + w.symbols), seg(0xC4, b"\x10" + w.counts + w.symbols)]
    scan = lambda ids, a, b, hi, lo: seg(0xDA, bytes([len(ids), *(x for i in ids for x in (i, 0)), a, b, hi << 4 | lo]))
    order = [(i, planes[i][y * v + b, x * h + a]) for y in range(down) for x in range(across) for i, h, v in shape for b in range(v) for a in range(h)]
    if not colour:
        rows, columns = -(-height // 8), -(-width // 8)
        order = [(1, planes[1][y, x]) for y in range(rows) for x in range(columns)]
    last = dict.fromkeys(planes, 0)
    for i, block in order:
        step = (int(block[0]) >> 1) - last[i]
        last[i] += step
        w.code(abs(step).bit_length())
        w.value(step)
    ids = tuple(planes)
    out += [scan(ids, 0, 0, 0, 1), w.data()]
    small = {i: planes[i][: -(-(-(-height * v // (2 if colour else 1))) // 8), : -(-(-(-width * h // (2 if colour else 1))) // 8)].reshape(-1, 64) for i, h, v in shape}
    for i in ids:
        out += [scan((i,), 1, 5, 0, 2), ac_first(w, small[i], 1, 5, 2), scan((i,), 6, 63, 0, 1), ac_first(w, small[i], 6, 63, 1)]
        out += [scan((i,), 1, 5, 2, 1), ac_refine(w, small[i], 1, 5, 1)]
    for _, block in order:
        w.put(int(block[0]) & 1, 1)
    out += [scan(ids, 0, 0, 1, 0), w.data()]
    for i in ids:
        out += [scan((i,), 1, 63, 1, 0), ac_refine(w, small[i], 1, 63, 0)]
    image = media.decode(b"".join([*out, b"\xff\xd9"]))
    for c in image.components:
        got, want = c.coefficients[: c.rows, : c.columns], planes[c.ident][: c.rows, : c.columns]
        assert np.array_equal(got, want)
    assert image.rgb().shape == (height, width, 3)


def test_inverse_transform():
    flat = np.zeros(64)
    flat[0] = 80
    assert np.allclose(flat.astype(np.float32) @ media.INVERSE, 10)
    assert media.ZIGZAG[:10].tolist() == [0, 1, 8, 16, 9, 2, 3, 10, 17, 24]


def plain_rgb(image):
    """RGB by sums over cosines, pixel by pixel, in double precision and without any array."""
    def wave(x, u):
        return math.cos((2 * x + 1) * u * math.pi / 16) * (math.sqrt(1 / 8) if u == 0 else 0.5)

    order = sorted(((i, j) for i in range(8) for j in range(8)), key=lambda p: (p[0] + p[1], p[0] if (p[0] + p[1]) % 2 else p[1]))
    hs, vs = max(c.h for c in image.components), max(c.v for c in image.components)

    def sample(c, y, x):
        y, x = y * c.v // vs, x * c.h // hs
        block = c.coefficients[y // 8, x // 8].tolist()
        q = image.quantisers[c.table].tolist()
        total = sum(block[k] * q[k] * wave(y % 8, i) * wave(x % 8, j) for k, (i, j) in enumerate(order) if block[k])
        return min(255, max(0, round(total + 128)))

    out = []
    for y in range(image.height):
        for x in range(image.width):
            a, b, r = (sample(c, y, x) for c in image.components)
            rgb = a + 1.402 * (r - 128), a - 0.344136 * (b - 128) - 0.714136 * (r - 128), a + 1.772 * (b - 128)
            out.append([min(255, max(0, round(v))) for v in rgb])
    return np.array(out).reshape(image.height, image.width, 3)


def plain_feature(rgb):
    h, w, _ = rgb.shape
    grey, cells = rgb.sum(axis=2).tolist(), ""
    all_grey = sum(map(sum, grey))
    for i in range(8):
        for j in range(8):
            part = [grey[y][x] for y in range(i * h // 8, (i + 1) * h // 8) for x in range(j * w // 8, (j + 1) * w // 8)]
            cells += "01"[sum(part) * h * w > all_grey * len(part)]
    mean = [sum(int(v) for v in rgb[:, :, k].ravel()) * 100 // (h * w) for k in range(3)]
    return f"{w}x{h} {mean[0]} {mean[1]} {mean[2]} {int(cells, 2):016x}"


@pytest.mark.parametrize("n", [1, 7, 20])
def test_rgb_and_feature(n):
    payload = " ".join(random.Random(n).choice(["Some words,", "123", "of text.", "Ünïcode", "    ", "~{}^"]) for _ in range(900)).encode()[: 64 * n]
    image = media.decode(media.pack(payload))
    rgb, want = image.rgb(), plain_rgb(image)
    assert np.abs(rgb.astype(int) - want).max() <= 2 and (rgb != want).mean() < 0.01  # halves may round either way in single precision
    assert media.feature(rgb) == plain_feature(rgb)


def test_packed_files_are_walked():
    """What ``pack`` writes has runs, ends of band over several blocks, and refined coefficients that were 0 before."""
    rng = random.Random(2)
    for payload in (b" " * 64 * 40000, b" " * 6400 + b"end." + b" " * 60, bytes(range(256)) * 3, b"e t a " * 320, bytes(rng.randrange(256) for _ in range(6400)), b" " * 63 + b"Z" + b"\0" * 640):
        data = media.pack(payload)
        assert media.unpack(media.decode(data)) == payload
        with pytest.raises(ValueError):
            media.decode(data[: data.rindex(b"\xff\xda") + 13])  # nothing left of the last scan
    assert len(media.pack(b"the same words again and again, " * 2000)) < 0.8 * 64000


def test_tensors(spark):
    files = spark.createDataFrame([(1, media.pack(b"a" * 6400)), (2, None), (3, b"no image"), (3, b"")], "media_id long, media binary")
    got = {(r["media_id"], r["width"], r["rgb"] and len(r["rgb"])) for r in media.tensors(files).collect()}
    assert got == {(1, 80, 80 * 64 * 3), (2, None, None), (3, None, None)}


def sets_of(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])


def groups(texts):
    """Components by comparing all pairs."""
    sets = [(i, sets_of(t)) for i, t in texts if i is not None]
    parent = {i: i for i, _ in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 90 * len(a | b):
            x, y = sorted((top(i), top(j)))
            parent[y] = x
    return {i: top(i) for i in parent}


def planted(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    out = []
    for base in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([3, 6, 12, 25, 60, 150, 400]))]
        for _ in range(12):
            copy = list(text)
            for _ in range(rng.randrange(0, 1 + len(text) // 25)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy[: len(copy) - rng.randrange(0, 1 + len(copy) // 40)]))
    rng.shuffle(out)
    return [(1000 + i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("seed, crowd", [(1, 64), (2, 2)])
def test_jaccard(spark, seed, crowd, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "CROWD", crowd)
    texts = planted(seed) + [(i, t) for i, t in ODD if i != 6] + [(40, "A b C"), (41, "a B c"), (42, "a b"), (43, "a\tB"), (44, "a b c d")]
    got = ngram_jaccard.linked(docs(spark, texts)).collect()
    want = groups(texts)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(sets_of(t)) for i, t in texts}
    assert len(set(want.values())) < len(texts) - 20


def test_jaccard_odd(spark):
    long = " ".join(f"w{i}" for i in range(200))
    texts = [(1, long), (1, long), (2, long + " x"), (3, "other words here to see"), (3, long), (None, long), (None, None), (4, None)]
    got = sorted(((r["doc_id"], r["component_id"]) for r in ngram_jaccard.linked(docs(spark, texts)).collect()), key=repr)
    assert len(got) == len(texts)
    assert {p for p in got if p[0] is not None} == {(1, 1), (2, 1), (3, 1), (4, 4)}
    assert ngram_jaccard.linked(docs(spark, [])).count() == 0
    kept = ngram_jaccard.keep_one(docs(spark, [(1, long), (2, long), (3, "b c d")]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3] and kept.columns == docs(spark, []).columns


def test_jaccard_frames(spark):
    """Texts of one frame share buckets without linking; near copies among them still link."""
    rng = random.Random(6)
    frame = [f"f{i}" for i in range(60)]
    texts = [(i, " ".join(frame + [f"w{rng.randrange(10**6)}" for _ in range(12)])) for i in range(2000)]
    texts += [(5000 + i, t + " z") for i, t in texts[:300]]
    got = {r["doc_id"]: r["component_id"] for r in ngram_jaccard.linked(docs(spark, texts)).collect()}
    assert got == {i: i % 5000 for i, _ in texts}


def test_jaccard_ids_shared(spark):
    """Different texts of one id keep their own links."""
    a, b = (" ".join(f"{x}{i}" for i in range(200)) for x in "ab")
    texts = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, "c " * 9), (None, a)]
    got = [(r["doc_id"], r["component_id"], r["class_id"]) for r in ngram_jaccard.linked(docs(spark, texts)).collect()]
    assert sorted(got, key=repr) == sorted([(1, 1, 1), (1, 1, 1), (2, 1, 2), (3, 1, 3), (4, 4, 4), (None, None, None)], key=repr)
    kept = ngram_jaccard.keep_one(docs(spark, texts))
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 1, 4, None]


def test_plans_cover_the_difference():
    join = ngram_jaccard.Join()
    lows = join.bands(5000)
    for n in (0, 10**4, 10**9):
        for b, (m, k) in enumerate(ngram_jaccard.allocate(join, lows, dict.fromkeys(range(len(lows)), n))):
            need = join.most_apart(lows[b + 1] - 1 + join.partner(lows[b + 1] - 1)) + 1
            assert k <= m and (m + k == need or (need == 1 and m == 0))
    for n in range(1, 5000):
        b = int(np.searchsorted(lows, n, "right")) - 1
        assert int(np.searchsorted(lows, join.partner(n), "right")) - 1 <= b + 1


def test_one_deletion_neighbours():
    """With tolerant segments too, every pair within the bound shares a signature."""
    join, rng = ngram_jaccard.Join(), np.random.default_rng(4)
    lows = join.bands(400)
    plans = [(m - j, j) if (j := min(m // 2, 8)) else (m, 0) for m, _ in ngram_jaccard.allocate(join, lows, {})]
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, rng.integers(10, 390), dtype=np.uint64))
        out = rng.integers(0, 1 + len(a) // 20)
        b = np.unique(np.concatenate([a[out:], rng.integers(0, 2**63, rng.integers(0, 1 + len(a) // 20), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 90 * (len(a) + len(b) - both):
            continue
        small, large = sorted((a, b), key=len)
        band = int(np.searchsorted(lows, len(small), "right")) - 1
        if plans[band][0]:
            assert set(ngram_jaccard.signatures(small, band, plans[band])) & set(ngram_jaccard.signatures(large, band, plans[band]))


def test_jaccard_crowd_rows(spark, monkeypatch):
    """A node in several crowded buckets has its keys once, and its links are kept."""
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(300):  # near copies, most of which link with few others only
        words = list(base)
        for at in rng.choice(60, 2 + i % 3, replace=False):
            words[at] = f"x{i}_{at}"
        texts.append((i, " ".join(words)))
    sets = [set(map(int, ngram_jaccard.shingles(t))) for _, t in texts]
    made, real = [], ngram_jaccard.materialize

    def seen(df):
        out = real(df)
        if "keys" in out.columns:
            made.append((out.count(), out.select("node").distinct().count()))
        return out

    monkeypatch.setattr(ngram_jaccard, "materialize", seen)
    got = {r["doc_id"]: r["component_id"] for r in ngram_jaccard.linked(docs(spark, texts)).collect()}
    root = list(range(300))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in range(300):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert got == {i: find(i) for i in range(300)}
    assert made and all(rows <= 48 * nodes for rows, nodes in made)
