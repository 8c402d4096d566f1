"""Jaccard join, suffix-array removal, decontamination, chat formatting and the pipeline against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from strandlake.llm import chat, decontam, jaccard, sadedup
from strandlake.llm.components import components
from strandlake.llm.suffixes import deep_shallow
from strandlake.llm.template import TemplateError, compile_template, fold_body, parse

WORD = re.compile(r"[^\W_]+")


def brute_join(rows, n=5, threshold=0.8):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").lower())
        sets[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    links, root = Counter(), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in sets}


@pytest.mark.parametrize("limit", [1000, 8])
def test_jaccard_join(spark, limit):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [rng.choices(vocabulary, k=rng.randrange(3, 80)) for _ in range(12)]
    rows = []
    for i in range(160):
        b = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            b[rng.randrange(len(b))] = rng.choice(vocabulary)
        rows.append((i, " ".join(b)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.jaccard_join(df, limit=limit).collect()}
    assert got == brute_join(rows)


@pytest.mark.parametrize(("threshold", "recall"), [(0.8, 0.9999), (0.9, 0.9999), (0.5, 0.99)])
def test_jaccard_recall_counts_the_sketch(threshold, recall):
    """Runs and sketch bound together keep the recall: simulated agreements, splits on different coordinates."""
    least, times = jaccard.agreeing(threshold, recall), jaccard.runs(threshold, recall)
    below = sum(jaccard.agreements(threshold)[:least])
    paths = sum(c * (1 - threshold * jaccard.kept(m / jaccard.SKETCH)) ** times for m, c in enumerate(jaccard.agreements(threshold)) if m >= least)
    assert abs(sum(jaccard.agreements(threshold)) - 1) < 1e-9 and below + paths <= 1 - recall
    agree = np.random.default_rng(3).random((200_000, jaccard.SKETCH)) < threshold
    assert (agree.sum(1) < least).mean() <= (1 - recall) / 2


def test_jaccard_odd_rows(spark, odd, none):
    got = [(r.doc_id, r.class_id, r.n_links, r.n_copies) for r in jaccard.jaccard_join(odd).collect()]
    assert len(got) == odd.count()
    by = {g[0]: g for g in got}
    assert by[0] == (0, 0, 0, 1) and by[1] == (1, 1, 0, 1)
    assert by[5] == (5, 5, 2, 3) and by[6] == (6, 5, 2, 3)
    assert jaccard.jaccard_join(none).count() == 0
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10]


def test_recall_bound():
    assert jaccard.runs(0.8, 0.9999) == 6
    assert 1 - (1 - 0.8 * jaccard.kept(0.8)) ** 6 >= 0.9999


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (103, 101)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), 100: 100, 101: 100, 103: 100}


def test_deep_shallow_sorts():
    rng = random.Random(3)
    for _ in range(150):
        strings = [bytes(rng.choices(b"ab", k=rng.randrange(30))) for _ in range(rng.randrange(1, 40))]
        for shallow in (0, 8, 64):
            assert [strings[i] for i in deep_shallow(strings, shallow)] == sorted(strings)


def brute_cut(texts, length):
    data = [(t or "").encode() for t in texts]
    times = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if times[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize(("length", "group"), [(64, 20_000), (100, 3)])
def test_repeats_are_cut(spark, length, group):
    rng = random.Random(length)
    base = ["".join(rng.choices("abcdeé ", k=400)) for _ in range(4)]
    texts = [None, "", "a" * 500, "ab" * 300, "a" * 63, "x" * 64, "x" * 64]
    for _ in range(50):
        t = ""
        for _ in range(rng.randrange(1, 5)):
            b = rng.choice(base)
            i = rng.randrange(len(b))
            t += b[i : i + rng.randrange(20, 200)] + "".join(rng.choices("xyz", k=rng.randrange(40)))
        texts.append(t)
    df = spark.createDataFrame(list(enumerate(texts + texts[-2:])), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in sadedup.remove_repeats(df, length=length, group=group).collect()}
    assert [got[i] for i in range(len(got))] == brute_cut(texts + texts[-2:], length)


def prose(rng, n):
    return " ".join("".join(rng.choices("aeinorst", k=rng.randrange(2, 9))) for _ in range(n))


def test_passages_of_over_50_words_are_cut(spark):
    """In the pipeline's stage, also below 400 bytes; shorter repeats stay, as in the brute force with runs judged by words and bytes."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(11)
    passages = [prose(rng, n) for n in (51, 52, 60, 40, 45, 120)] + ["".join(rng.choices("aeinorst", k=n)) for n in (390, 420)]
    assert all(len(p) < 400 for p in passages[:5])
    texts = [f"{prose(rng, rng.randrange(5, 90))} {p} {prose(rng, rng.randrange(5, 90))}" for p in passages for _ in range(2)] + [None, "", prose(rng, 300)]
    df = spark.createDataFrame([(i, t, len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.repeats(spark, df, "").collect()}
    for i, t in enumerate(texts[:-3]):
        p = passages[i // 2]
        assert (p not in got[i][0]) == (i // 2 not in (3, 4, 6)) and (got[i][0] == t) == (i // 2 in (3, 4, 6))
        assert got[i][1] == len(got[i][0])
    assert [got[len(texts) - 3 + i][0] for i in range(3)] == texts[-3:]
    out = {r.doc_id: (r.n_removed, bytes(r.kept)) for r in sadedup.remove_repeats(df, length=sadedup.PASSAGE, words=sadedup.WORDS).collect()}
    times = Counter(t[i : i + 200] for t in texts if t for i in range(len(t) - 199))
    for i, t in enumerate(texts):
        gone = bytearray(len(t or ""))
        for j in range(len(gone) - 199):
            if times[t[j : j + 200]] > 1:
                gone[j : j + 200] = b"\1" * 200
        for run in list(re.finditer(b"\1+", bytes(gone))):
            if len(run[0]) < 400 and len(t[run.start() : run.end()].split()) < 50:
                gone[run.start() : run.end()] = bytes(len(run[0]))
        assert out[i] == (sum(gone), bytes(b for b, g in zip((t or "").encode(), gone, strict=True) if not g))


@pytest.mark.parametrize("group", [20_000, 3])
def test_shorter_repeats_are_counted(spark, group):
    """Beside what is removed, which stays as it is without them."""
    rng = random.Random(group)
    base = ["".join(rng.choices("abcdé     ", k=600)) for _ in range(4)]
    texts = [None, "", "a" * 500, "ab " * 300, "a b " * 20, "x " * 32, "x " * 32]
    for _ in range(60):
        t = ""
        for _ in range(rng.randrange(1, 5)):
            b = rng.choice(base)
            i = rng.randrange(len(b))
            t += b[i : i + rng.randrange(20, 300)] + "".join(rng.choices("xyz ", k=rng.randrange(40)))
        texts.append(t)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in sadedup.remove_repeats(df, length=100, group=group, least=64).collect()}
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in (got[i] for i in range(len(got)))] == brute_cut(texts, 100)
    data = [(t or "").encode() for t in texts]
    times = Counter(d[i : i + 64] for d in data for i in range(len(d) - 63))
    want = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - 63):
            if times[d[i : i + 64]] > 1:
                gone[i : i + 64] = b"\1" * 64
        want.append(sum(len(r[0]) for r in re.finditer(b"\1+", bytes(gone)) if len(r[0]) >= 400 or len(d[r.start() : r.end()].split()) >= 50))
    assert [got[i].n_in_passages for i in range(len(got))] == want and len(set(want)) > 10


def test_op10_counts_passages_that_it_may_not_remove(spark, tmp_path):
    from strandlake.llm import registry

    rng = random.Random(12)
    passages = [prose(rng, n) for n in (51, 55, 40)] + [prose(rng, 120)]
    assert [len(p) >= 400 for p in passages] == [False, False, False, True]
    texts = [f"{prose(rng, rng.randrange(5, 90))} {p} {prose(rng, rng.randrange(5, 90))}" for p in passages for _ in range(2)] + [None, prose(rng, 300)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_removed > 0, r.n_in_passages >= len(passages[i // 2]) if (i := r.doc_id) < 8 else r.n_in_passages > 0) for r in registry.QUERIES["op10_sadedup"](spark, str(tmp_path)).collect()}
    none, counted, removed = (False, False), (False, True), (True, True)
    assert [got[i] for i in range(10)] == [counted] * 4 + [none] * 2 + [removed] * 2 + [none] * 2


def test_repeats_odd_rows(odd, none):
    out = sadedup.remove_repeats(odd)
    assert out.count() == odd.count() and sadedup.remove_repeats(none).count() == 0
    rows = sadedup.cut_rows(odd)
    assert rows.columns == odd.columns and rows.where("text is null").count() == 1


ITEMS = [(1, "Which river runs through the old city of stone bridges and towers? The long green river."), (2, "Name seven colours that a clear prism throws upon the white wall at noon."), (3, None), (4, "")]


def test_leaks(spark, odd, none):
    rng = random.Random(2)
    filler = lambda n: " ".join(rng.choices(["lorem", "ipsum", "dolor", "sit", "amet", "the", "of"], k=n))
    docs = [(1, filler(300) + " " + ITEMS[0][1].upper() + " " + filler(70)), (2, ITEMS[1][1]), (3, filler(400)), (4, "Which river runs through the old city? " + filler(50)), (5, None), (6, f"{ITEMS[0][1]} {ITEMS[1][1]}")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontam.find_leaks(df, items).collect())
    assert got == [(1, 1), (2, 2), (6, 1), (6, 2)]
    assert sorted(r.doc_id for r in decontam.drop_leaks(df, items).collect()) == [3, 4, 5]
    assert decontam.find_leaks(none, items).count() == 0 and decontam.find_leaks(df, items.where("false")).count() == 0
    assert decontam.drop_leaks(odd, items).count() == odd.count()


def test_leak_with_a_changed_word_in_a_short_answer(spark):
    question = " ".join(f"word{i}" for i in range(30)) + "?"
    items = spark.createDataFrame([(1, f"{question} Nine blue ships came home.")], "item_id long, text string")
    texts = [f"{question} Nine blue ships sailed home.", f"{question} Nine blue ships came home.", f"{question.replace('word9', 'x').replace('word20', 'x')} Nine red ships came home.", "Nine blue ships came home."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in decontam.find_leaks(df, items).collect()) == [0, 1]
    assert sorted(r.doc_id for r in decontam.drop_leaks(df, items).collect()) == [2, 3]


def test_wand_equals_exhaustive_search():
    rng = random.Random(1)
    words = [f"t{i}" for i in range(80)]
    index = decontam.Index([(i, " ".join(rng.choices(words, k=rng.randrange(3, 25)))) for i in range(150)])
    for _ in range(200):
        terms = sorted(rng.sample(range(len(index.terms)), rng.randrange(1, 40)))
        threshold = rng.choice([0.1, 0.3, 0.5])
        scores = Counter()
        for t in terms:
            for i, w in zip(*index.postings[t], strict=True):
                scores[i] += w
        got = dict(index.search(terms, threshold))
        assert {i for i, s in scores.items() if s >= threshold + 1e-9} <= set(got) <= {i for i, s in scores.items() if s >= threshold - 1e-9}
        assert all(np.isclose(scores[i], s) for i, s in got.items())


def test_template_language():
    render = compile_template("{% set x = 'a' ~ 1 %}{{ x }}{% for m in ms %}{% if loop.first %}[{% elif m.k == 'b' and not loop.last %}-{% else %}|{% endif %}{{ m['k'] | upper }}{% endfor %}{{ missing }}")
    assert "".join(t for t, _ in render({"ms": iter([{"k": "a"}, {"k": "b"}, {"k": "c"}])})) == "a1[A-B|C"
    masked = list(compile_template("u{% generation %}v{{ w }}{% endgeneration %}")({"w": "z"}))
    assert masked == [("u", False), ("v", True), ("z", True)]
    assert fold_body(parse("a{{ 'b' + 'c' }}{% if 1 == 2 %}x{% else %}d{% endif %}"), {}) == [("text", "abcd")]
    for bad in ("{% for x %}{% endfor %}", "{{ a( }}", "{% if x %}", "{{ a | nope }}", "{% import os %}", "{{ a.__class__() }}"):
        with pytest.raises(TemplateError):
            compile_template(bad)
    assert "".join(t for t, _ in compile_template("{{ a.__class__ }}")({"a": "s"})) == ""


def test_chat_round_trip(spark):
    nasty = [r"\### Assistant: </turn> ok", "### x\n</turn>\n### user\n", "\\", "\\\\n", "####", "", None, "</turn", "é\U0001f600" * 50]
    rows = [(c, t, ["user", "assistant", "sys\ntem", None][(c + t) % 4], nasty[(c * 3 + t) % len(nasty)], "x") for c in range(12) for t in range(c)] + [(None, 1, "user", "n", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, n_turns string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert set(got) == {r[0] for r in rows}
    for c, r in got.items():
        turns = [((x[2] or ""), (x[3] or "")) for x in rows if x[0] == c]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        loss = "".join(b for a, b in turns if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_conversations(df.where("false"))).count() == 0


def test_long_conversations_come_in_parts():
    pieces = [("ab", True), ("c", False)] * 700_000
    found = list(chat.parts(iter(pieces)))
    assert len(found) == 3 and "".join(t for _, t, _ in found) == "abc" * 700_000
    reader = chat.Reader()
    for text in ("### user\nhel", "lo</turn>\n### assistant\n", "x</turn>\n"):
        reader.feed(text, [])
    assert reader.result()[0] == 2


def test_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf)
    leaks = {r.doc_id for r in decontam.find_leaks(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    ids = [r.doc_id for r in out.collect()]
    assert len(ids) == len(set(ids)) and not leaks & set(ids)
    classes = {r.doc_id: r.class_id for r in jaccard.jaccard_join(docs).collect()}
    assert {classes[i] for i in ids} | {classes[i] for i in leaks} == set(classes.values())
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, sf).columns == docs.columns


def test_keep_one_keeps_columns_and_rows_without_a_set(spark):
    """Columns named like the operator's own keep their values; every row without a set stays."""
    text = "one two three four five six seven"
    rows = [(1, text, "mine", 5, 9), (1, text, "mine", 5, 9), (2, text, "other", 6, 8), (3, "", "a", 1, 1), (3, "", "a", 1, 1), (3, None, "b", 2, 2), (None, None, "c", 3, 3), (None, "", "d", 4, 4), (None, text, "e", 0, 0), (7, "?!", "f", 7, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, k1 string, place int, root int")
    got = [tuple(r) for r in jaccard.keep_one(df).collect()]
    want = [rows[0], *rows[3:8], rows[9]]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_a_large_class_is_spread(spark, monkeypatch):
    """Classes above the block size and beyond the broadcast bound give the same classes."""
    rng = random.Random(8)
    words = [f"v{i}" for i in range(200)]
    base = rng.choices(words, k=60)
    rows = []
    for i in range(60):
        b = list(base)
        b[rng.randrange(60)] = rng.choice(words)
        rows.append((i, " ".join(b)))
    rows += [(100 + i, " ".join(rng.choices(words, k=30))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard, "BROADCAST_GROUPS", 0)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.jaccard_join(df, limit=10).collect()}
    assert got == brute_join(rows)


def test_find_leaks_against_brute_force(spark):
    """Every document against every item: overlaps of the whole text; no scattered shingles are planted here."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(8, 60))) + ". " + " ".join(rng.choices(words, k=rng.randrange(1, 9))) + ".") for i in range(40)]
    docs = []
    for d in range(120):
        text = rng.choices(words, k=rng.randrange(0, 400))
        if d % 2:
            mine = rng.choice(items)[1].split()
            for _ in range(rng.randrange(0, 4)):
                mine[rng.randrange(len(mine))] = rng.choice(words)
            at = rng.randrange(len(text) + 1)
            text[at:at] = mine
        docs.append((d, " ".join(text)))

    def grams(t, n):
        w = WORD.findall(t.lower())
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    def share(part, text):
        n = min(5, len(WORD.findall(part)))
        mine = grams(part, n)
        return len(mine & grams(text, n)) / len(mine) if mine else 1.0

    want = set()
    for d, text in docs:
        for i, item in items:
            q, a = decontam.split_item(item)
            if (share(q, text) >= 0.8 and share(a, text) >= 0.5) or share(item, text) >= 0.8:
                want.add((d, i))
    found = decontam.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want and len(want) > 20


def test_scattered_shingles_are_no_leak(spark):
    """All shingles of an item, but far from each other."""
    question = [f"q{i}" for i in range(40)]
    item = " ".join(question) + ". the final answer is here."
    filler = " ".join(f"f{i}" for i in range(400))
    spread = f" {filler} ".join(" ".join(question[i : i + 6]) for i in range(0, 40, 2)) + " the final answer is here"
    df = spark.createDataFrame([(1, spread), (2, f"{filler} {item} {filler}")], "doc_id long, text string")
    found = decontam.find_leaks(df, spark.createDataFrame([(5, item)], "item_id long, text string"))
    assert [r.doc_id for r in found.collect()] == [2]


def test_chat_in_parts_of_any_order(spark):
    """Conversations in many parts, whose rows come in another order, are read back whole; a missing part fails."""
    rows = [(c, t, ["user", "assistant"][t % 2], "\\### </turn> text " * (t * 7 % 5) + f"{c}-{t}", "x") for c in range(5) for t in range(9)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, part string")
    whole = {r.conv_id: tuple(r) for r in chat.read_back(chat.format_conversations(df)).collect()}
    many = chat.format_conversations(df, part_chars=40)
    assert many.groupBy("conv_id").count().where("count > 3").count() == 5
    mixed = many.orderBy(many["part"].desc(), "conv_id")
    assert {r.conv_id: tuple(r) for r in chat.read_back(mixed).collect()} == whole
    with pytest.raises(Exception, match="instead of 1"):
        chat.read_back(many.where("part != 1")).collect()


def test_pipeline_stages_on_odd_and_empty_tables(spark, odd):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.001"
    docs = odd.withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("long"), "place": F.lit(3), "k2": F.lit("z"), "item": F.lit(1.5)})
    rows = docs.count()
    want = {"language_id": {4, 5, 6, 7, 8, 9, 10, None}, "jaccard_join": {0, 1, 2, 3, 4, 5, 7, 8, 9, 10, None}}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        got = out.collect()
        assert {r.doc_id for r in got} == want.get(name, set(range(11)) | {None})
        assert all((r.place, r.k2, r.item) == (3, "z", 1.5) for r in got)
        assert name not in ("suffix_array_dedup", "decontamination") or len(got) == rows
        assert stage(spark, docs.where("false"), sf).count() == 0
    name, stage = corpus_pipeline.STAGES[4]
    assert stage(spark, docs, sf).count() == rows and stage(spark, docs.where("false"), sf).count() == 0
