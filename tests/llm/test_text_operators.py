"""BPE, media, language ID, quality, licences and LM scores against independent versions."""

import base64
import hashlib
import io
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from strandlake.llm import bpe, langid, licenses, lmscore, media, quality

PATH = P.path("byte_bpe_50k.tiktoken")
WORD = re.compile(r"[^\W_]+")


@pytest.fixture(scope="module")
def codecs():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return bpe.codec(PATH, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_bpe_equals_tiktoken(text):
    ours = bpe.codec(PATH, P.PATTERN)
    packed = ours.encode(text)
    theirs = test_bpe_equals_tiktoken.encoder = getattr(test_bpe_equals_tiktoken, "encoder", None) or tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})
    assert np.frombuffer(packed, "<u4").tolist() == theirs.encode_ordinary(text)
    assert ours.decode(packed) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, "é" * 999, " " * 4000 + "x", "<|endoftext|>", "xyzzy" * 700])
def test_bpe_long_pretokens(codecs, text):
    ours, theirs = codecs
    assert np.frombuffer(ours.encode(text), "<u4").tolist() == theirs.encode_ordinary(text)


def test_rank_queue_orders_by_rank_then_position():
    q, rng, held = bpe.RankQueue(), random.Random(1), []
    for _ in range(2000):
        if held and rng.random() < 0.4:
            assert q.pop() == held.pop(0)
        else:
            x = rng.randrange(50_000), rng.randrange(9999)
            q.push(*x)
            held = sorted([*held, x])
    assert [q.pop() for _ in held] == held
    assert q.pop() is None


def least_rank_first(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while found := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]:
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


@pytest.mark.parametrize("seed", range(20))
def test_bpe_together_and_any_order_of_ranks(seed):
    """Many pre-tokens at once, with ranks in which a longer token can come before its parts."""
    rng = random.Random(seed)
    tokens = {"".join(rng.choices("abc", k=rng.randint(2, 6))).encode() for _ in range(120)}
    order = [*tokens]
    rng.shuffle(order)
    ranks = {t: 1000 + i for i, t in enumerate(order)} | {bytes((b,)): b for b in range(256)}
    pieces = ["".join(rng.choices("abcd", k=rng.randint(0, 30))).encode() for _ in range(60)]
    assert bpe.merge_all(pieces, ranks) == [[ranks[p]] if p in ranks else least_rank_first(p, ranks) for p in pieces]


def test_bpe_memory(monkeypatch):
    """A small memory changes no ids; another run finds it empty."""
    monkeypatch.setattr(bpe, "MEMORY", 3)
    small, text = bpe.Codec(PATH, P.PATTERN), " alpha betaqz gammaqz deltaqz alpha betaqz epsilonqz gammaqz alpha"
    small.begin("one")
    assert small.decode(small.encode(text * 3)) == (text * 3).encode()
    assert small.encode(text) == b"".join(bpe.pack("<I", i) for p in small.split.findall(text) for i in bpe.merge(p.encode(), small.ranks))
    assert len(small) <= 3 and len(small.older) == 3
    small.begin("one")
    assert small.older
    small.begin("two")
    assert not small and not small.older


def test_bpe_frame(odd, none, codecs):
    out = bpe.encode(odd, PATH, P.PATTERN).collect()
    assert len(out) == odd.count() and bpe.encode(none, PATH, P.PATTERN).count() == 0
    for r in out:
        if r.doc_id is not None:
            text = odd.where(odd.doc_id == r.doc_id).first().text or ""
            assert r.ids == codecs[1].encode_ordinary(text) and bytes(r.decoded) == text.encode()


def test_media_round_trips():
    rng = np.random.default_rng(1)
    for shape in [(1, 64), (5, 7), (4, 64), (3, 5, 3), (9, 4, 3)]:
        image = rng.integers(0, 256, shape, dtype=np.uint8)
        for write in (media.write_netpbm, media.write_bmp):
            assert (media.decode(write(image)) == image).all()
    assert media.decode(b"P1 # c\n3 1\n1 0 1").tolist() == [[0, 255, 0]]
    assert media.decode(b"P2\n2 1\n255\n3 4").tolist() == [[3, 4]]
    assert media.decode(b"P4\n3 1\n\xa0").tolist() == [[0, 255, 0]]
    assert media.decode(b"P3\n1 1\n255\n1 2 3").tolist() == [[[1, 2, 3]]]
    with pytest.raises(ValueError):
        media.decode(b"GIF8")


def test_area_resize_is_the_mean_under_each_pixel():
    image = np.arange(12.0).reshape(3, 4)
    assert np.allclose(media.area_resize(image, 3, 4), image)
    assert np.allclose(media.area_resize(image, 1, 1), image.mean())
    fine = np.kron(image, np.ones((8, 9)))
    want = fine.reshape(8, 3, 9, 4).mean((1, 3))
    assert np.allclose(media.area_resize(image, 8, 9), want)


def test_media_frame(odd, none):
    out = {r.doc_id: r for r in media.media_features(media.store_media(odd)).collect() if r.doc_id is not None}
    for r in odd.collect():
        if r.doc_id is None:
            continue
        raw = (r.text or "").encode()
        padded = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        got = out[r.doc_id]
        assert (got.n_bytes, got.payload_bytes, got.payload_sha256) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest())
        assert np.load(io.BytesIO(got.npy)).shape == (media.TILE, media.TILE)
    assert out[5].feature == out[6].feature and out[5].media_sha256 == out[6].media_sha256
    assert media.media_features(media.store_media(none)).count() == 0


def brute_grams(text):
    out = Counter()
    for w in "".join(c.lower() if c.isalpha() else " " for c in text).split():
        padded = "\x01" + w + "\x01"
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                g = padded[i : i + n]
                if g != "\x01":
                    out[sum(ord(c) << 21 * (n - 1 - j) for j, c in enumerate(g))] += 1
    return out


def test_langid_grams_and_distance(spark, odd, none):
    texts = ["", "...", "a", "Ab c", " x.y ", "É1è", "The cat sat on the mat"]
    found = langid.grams(texts)
    for i, t in enumerate(texts):
        assert Counter(np.concatenate([k[b[i] : b[i + 1]] for k, b in found]).tolist()) == brute_grams(t)
    train = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("x", None)], "text string, lang string")
    profiles = langid.learn(train)
    top = sorted(brute_grams("der hund und die katze").items(), key=lambda x: (-x[1], x[0]))
    assert profiles[0] == ("de", [k for k, _ in top][: langid.PROFILE])
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd, profiles).collect()}
    assert [got[i] for i in range(4)] == [("und", 0.0)] * 4 and got[4][0] in ("de", "en")
    model = dict(profiles)
    mine = [k for k, _ in sorted(brute_grams("the dog").items(), key=lambda x: (-x[1], x[0]))]
    want = min((sum(abs(p.index(k) - i) if k in p else langid.PROFILE for i, k in enumerate(mine)), n) for n, p in model.items())
    one = langid.identify(spark.createDataFrame([(1, "the dog")], "doc_id long, text string"), profiles).first()
    assert one.lang_pred == want[1] and math.isclose(one.score, 1 - want[0] / langid.PROFILE / len(mine))
    assert langid.identify(none, profiles).count() == 0 and langid.learn(none) == []


def test_quality_gradients_and_frame(spark, odd, none):
    rng = np.random.default_rng(2)
    bags = [rng.normal(size=(n, quality.FEATURES)) for n in (1, 3, 2)]
    x, owner, starts, y = np.concatenate(bags), np.array([0, 1, 1, 1, 2, 2]), np.array([0, 1, 4]), np.array([1.0, 0, 1])
    model = quality.Model()
    loss = lambda: float(-np.mean(y * np.log(model.forward(x, starts, owner)["p"]) + (1 - y) * np.log(1 - model.forward(x, starts, owner)["p"])))
    for name, grad in model.gradients(x, starts, owner, y).items():
        at = tuple(0 for _ in grad.shape)
        held = model.w[name][at]
        model.w[name][at] = held + 1e-5
        up = loss()
        model.w[name][at] = held - 1e-5
        down = loss()
        model.w[name][at] = held
        assert math.isclose((up - down) / 2e-5, grad[at], rel_tol=1e-3, abs_tol=1e-7)
    good = [(i, f"Calm words number {i} follow each other in plain order.", 1) for i in range(60)]
    bad = [(100 + i, f"BUY!! NOW!! {i}%%% ###" * 4, 0) for i in range(60)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, q int")
    fitted = quality.learn(docs.select("doc_id", "text"), docs.where("doc_id % 4 != 0").selectExpr("doc_id", "q AS quality"))
    out = quality.score(docs, fitted).join(docs, "doc_id").collect()
    assert all(r.predicted == r.q for r in out)
    assert quality.score(odd, fitted).count() == odd.count() and quality.score(none, fitted).count() == 0
    assert quality.learn(none, docs.where("false").selectExpr("doc_id", "q AS quality")) is None
    assert {r.score for r in quality.score(odd, None).collect()} == {0.5}


def test_licences(spark, odd, none):
    texts = {1: "Text.\nReleased under the MIT License.\nMore text.", 2: "LICENSED*** under%%% the### Apache$$$ License,&&& Version 2.0.", 3: "The MIT is an institute.", 4: "This work is licensed under the GNU General Public License, version 3.\nLicensed under CC BY-NC 4.0."}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in licenses.scan(df).collect()}
    assert got == {1: "MIT", 2: "Apache-2.0", 3: "", 4: "CC-BY-NC-4.0,GPL-3.0"}
    assert licenses.scan(odd).where("n_licenses = 0").count() == odd.count() and licenses.scan(none).count() == 0


def test_licence_headers_and_whole_texts(spark):
    """Every header and whole text is its own licence, not a neighbour's, with words left out too."""
    header = "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    families = {"GPL-2.0": ("General", "2"), "GPL-3.0": ("General", "3"), "LGPL-2.1": ("Lesser General", "2.1"), "LGPL-3.0": ("Lesser General", "3"), "AGPL-3.0": ("Affero General", "3")}
    cases = [(name, f"/* {header.format(what, *f)} */") for name, f in families.items() for what in ("program", "library", "tool")]
    for path in sorted(licenses.TEXTS.glob("*.txt")):
        words = path.read_text("utf-8").split()
        name = path.stem.split("_")[0]
        cases += [(name, " ".join(words)), (name, "Before it. " + " ".join(w for i, w in enumerate(words) if i % 40) + " After it.")]
    assert {"Apache-2.0", "MIT", "BSD", "ISC", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "Unlicense"} <= {n for n, _ in cases}
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert [got[i].licenses for i in range(len(cases))] == [n for n, _ in cases]
    apache = (licenses.TEXTS / "Apache-2.0.txt").read_text("utf-8").split("APPENDIX")[0]
    part = licenses.scan(spark.createDataFrame([(1, apache + "Other words. " * 300)], "doc_id long, text string")).first()
    assert part.licenses == "Apache-2.0" and part.best_dice > 0.95


def brute_scores(texts, order):
    docs = [WORD.findall((t or "").lower()) for t in texts]
    grams = lambda d: Counter(tuple(d[i : i + n]) for n in range(1, order + 1) for i in range(len(d) - n + 1))
    total, tokens = sum((grams(d) for d in docs), Counter()), sum(map(len, docs))
    out = []
    for d in docs:
        own, rest, log = grams(d), max(1, tokens - len(d)), 0.0
        for i in range(len(d)):
            longest = min(order, i + 1)
            for n in range(longest, 0, -1):
                g = tuple(d[i - n + 1 : i + 1])
                if total[g] > own[g]:
                    below = total[g[:-1]] - own[g[:-1]] if n > 1 else rest
                    log += math.log((total[g] - own[g]) / below) + (longest - n) * math.log(lmscore.BACKOFF)
                    break
            else:
                log += -math.log(rest) + longest * math.log(lmscore.BACKOFF)
        out.append((len(d), log))
    return out


@pytest.mark.parametrize(("order", "block"), [(1, 500), (3, 500), (3, 10**7)])
def test_lm_scores(spark, odd, none, order, block):
    rng = random.Random(4)
    texts = [None, "", "the", "of the", "zz"] + [" ".join(rng.choices("a b c d e f g".split(), k=rng.randrange(1, 40))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in lmscore.score(df, order=order, block_chars=block).collect()}
    for i, (n, log) in enumerate(brute_scores(texts, order)):
        assert got[i].n_words == n and math.isclose(got[i].log_score, log, rel_tol=1e-9, abs_tol=1e-9)
    assert lmscore.score(none).count() == 0 and lmscore.score(odd).count() == odd.count()


def test_quality_forward_by_loops_and_whole_sample(spark, monkeypatch):
    """Attention over a bag as plain sums; documents count whole or not at all, repeated ids once."""
    texts = ["one two three. " * 60, "BUY NOW!!! " * 40, "", "x"]
    x, bounds = quality.encode(texts)
    model = quality.Model()
    got = model.forward(x.astype(float), bounds[:-1], np.repeat(np.arange(len(texts)), np.diff(bounds)))["p"]
    w = model.w
    for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
        passages = [np.tanh(x[j].astype(float) @ w["e"]) for j in range(a, b)]
        raw = [float((np.tanh(h @ w["v"]) / (1 + np.exp(-(h @ w["u"])))) @ w["a"]) for h in passages]
        share = [math.exp(r) / sum(map(math.exp, raw)) for r in raw]
        z = sum(s * h for s, h in zip(share, passages, strict=True))
        assert math.isclose(got[i], 1 / (1 + math.exp(-float(z @ w["c"] + w["b"][0]))), rel_tol=1e-9)
    held = []
    monkeypatch.setattr(quality.Model, "fit", lambda self, bags, labels: held.append((bags, labels)) or self)
    rows = [(1, "word " * 640), (2, "word " * 64), (2, "other " * 64), (3, "few words"), (4, "no label")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 1), (9, 1), (None, 1)], "doc_id long, quality int")
    quality.learn(docs, labels)
    assert sorted(map(len, held[0][0])) == [1, 1, 10] and sorted(held[0][1]) == [0, 1, 1]
    monkeypatch.setattr(quality, "TRAIN_PASSAGES", 5)
    quality.learn(docs, labels)
    assert sorted(map(len, held[1][0])) == [1, 1]


@pytest.mark.parametrize("seed", range(25))
def test_licence_dice_by_brute_force(seed):
    """Best Dice over every window that starts with a bigram of the template, by sets."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12 + seed)]
    templates = {f"T{i}": [" ".join(rng.choices(words, k=rng.randrange(4, 14))) for _ in range(2)] for i in range(4)}
    threshold = rng.choice([0.5, 0.7, 0.8])
    scanner = licenses.Scanner(templates, threshold)
    texts = []
    for _ in range(30):
        t = rng.choices(words, k=rng.randrange(0, 40))
        if rng.random() < 0.7:
            mine = rng.choice(rng.choice(list(templates.values()))).split()
            if rng.random() < 0.5:
                mine[rng.randrange(len(mine))] = rng.choice(words)
            at = rng.randrange(len(t) + 1)
            t[at:at] = mine
        texts.append(" ".join(t))

    def pairs(text):
        w = WORD.findall(text.lower())
        return list(zip(w, w[1:], strict=False))

    for text, found in zip(texts, scanner.scan(texts), strict=True):
        mine, best = pairs(text), {}
        for name, several in templates.items():
            for template in several:
                t = pairs(template)
                for a in range(len(mine)):
                    if mine[a] in t:
                        window = set(mine[a : a + len(t)])
                        best[name] = max(best.get(name, 0), 2 * len(window & set(t)) / (len(window) + len(set(t))))
        top = max(best.values(), default=0)
        assert (top >= threshold - 1e-9) == bool(found)
        if found:
            assert math.isclose(max(found.values()), top) and all(best[n] >= d - 1e-9 for n, d in found.items())


def test_media_features_by_loops():
    """Hash and tile of stored images from fractional areas summed pixel by pixel."""

    def mean(grey, y0, y1, x0, x1):
        total = 0.0
        for y in range(int(y0), math.ceil(y1 - 1e-9)):
            for x in range(int(x0), math.ceil(x1 - 1e-9)):
                total += grey[y][x] * (min(y + 1, y1) - max(y, y0)) * (min(x + 1, x1) - max(x, x0))
        return total / ((y1 - y0) * (x1 - x0))

    for text in ("a" * 10, "The quick brown fox jumps over the lazy dog. " * 5, "äöü漢字" * 40):
        data, n = media.store(text)
        image = media.decode(data)
        raw = text.encode().ljust(-(-len(text.encode()) // 64) * 64, b"\0")
        assert image.tobytes() == raw and n == len(text.encode())
        grey = [[p if image.ndim == 2 else 0.299 * p[0] + 0.587 * p[1] + 0.114 * p[2] for p in row] for row in image.tolist()]
        h, w = len(grey), len(grey[0])
        cells = lambda rows, cols: [[mean(grey, y * h / rows, (y + 1) * h / rows, x * w / cols, (x + 1) * w / cols) for x in range(cols)] for y in range(rows)]
        bits = "".join("1" if round(a, 6) < round(b, 6) else "0" for row in cells(8, 9) for a, b in zip(row, row[1:], strict=False))
        assert media.difference_hash(image) == f"{int(bits, 2):016x}"
        tile = np.load(io.BytesIO(media.tile(image)))
        assert np.abs(tile - np.array(cells(32, 32))).max() <= 0.5 + 1e-6
