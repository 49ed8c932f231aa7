"""Documents: quality rules, near duplicates, substring dedup, personal data, packing, tokens, against plain versions."""

import gc
import hashlib
import random
import re
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from codeloom.llm import bpe, minhash, packing, pii, quality, queries, substring, tokencount

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    None, "", " \n\t ", "one", "ONE one", "a b c d", "a\x1cb\xa0c", "Éé ﬁ Σ ΑΣ ß\r\n中文 😀", "x" * 3000, "7 " * 200, "<|endoftext|> a <|start",
    "\n\nline\nline\n line \nLINE", "#*$%&|<>" * 5,
]


def documents(spark, texts, parts=3):
    rows = [(i, t, "en", f"s{i % 2}" if i % 7 else None, len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(4)
    word = lambda: rnd.choice("the of and ing er on at re é ü's".split()) + rnd.choice("a e i o u th nd st ed ly".split()) * rnd.randint(0, 3)
    passage = " ".join(word() for _ in range(60))
    out = list(ODD)
    for _ in range(25):
        base = [word() for _ in range(rnd.randint(1, 250))]
        for _ in range(rnd.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rnd.choice([0, 1, 4])):
                copy[rnd.randrange(len(copy))] = word()
            text = " ".join(copy)
            if rnd.random() < 0.3:
                text += "\n" + passage + "\n" + text[: rnd.randint(0, len(text))]
            out.append(text)
    return out + [out[20], out[20]]


def words(text):
    return WORD.findall(text or "")


def union(links, ids):
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        parent[high] = low
    return {i: top(i) for i in ids}


def collected(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# Near duplicates.


def plain_sets(texts):
    sets = []
    for t in texts:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return sets


@pytest.mark.parametrize("block", [minhash.BLOCK_SHINGLES, 300])
def test_near_duplicates_match_all_pairs(spark, texts, block):
    sets = plain_sets(texts)
    links = [
        (i, j) for j in range(len(sets)) for i in range(j)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    ]
    top = union(links, range(len(texts)))
    got = collected(minhash.near_duplicates(documents(spark, texts), block=block))
    assert {i: tuple(got[i])[1:] for i in got} == {i: (len(s), top[i], top[i] == i) for i, s in enumerate(sets)}
    assert len(set(top.values())) < len(texts)


def test_near_duplicates_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).collect() == []
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (1, None)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(None, 2, None, True)] * 2 + [(3, 2, 3, True)] * 2 + [(1, 0, 1, True)], key=str
    )


def test_one_of_each_keeps_columns(spark, texts):
    docs = documents(spark, texts).withColumn("n", F.lit(1)).withColumn("component_id", F.lit(2))
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    top = collected(minhash.near_duplicates(docs))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in top.items() if r["kept"])


def test_pipeline_stage_links_from_80_percent(spark):
    rnd = random.Random(8)
    texts = []
    for n in (60, 120, 300):
        for changed in range(n // 40, n // 8):
            base = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
            texts += [" ".join(base), " ".join([*base[: n - changed], *[f"v{rnd.randrange(10**6)}" for _ in range(changed)]])]
    sets = plain_sets(texts)
    share = [(i, j, len(sets[i] & sets[j]) / len(sets[i] | sets[j])) for j in range(len(sets)) for i in range(j)]
    assert sum(0.8 <= s < 0.85 for _, _, s in share) > 5 and sum(0.75 < s < 0.8 for _, _, s in share) > 5
    links = [(i, j) for i, j, _ in share if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    top = union(links, range(len(texts)))
    got = corpus_pipeline.near_duplicates(spark, documents(spark, texts), "")
    assert sorted(r["doc_id"] for r in got.collect()) == [i for i in range(len(texts)) if top[i] == i]


def test_estimates_do_not_lose_links():
    rng = np.random.default_rng(3)
    lost = 0
    for _ in range(60):
        base = np.unique(rng.integers(0, 2**63, 2000).astype(np.uint64))
        cut = int(len(base) * 0.075)
        other = np.unique(np.r_[rng.permutation(base)[cut:], rng.integers(0, 2**63, cut).astype(np.uint64)])
        lost += not minhash.links_of([base, other], np.array([False, False]), minhash.RETAINED, 85)
        assert minhash.overlaps([base, other])[0, 1] == len(np.intersect1d(base, other))
    assert lost == 0


# Substring dedup.


def plain_removal(rows, width=20):
    seen, out = set(), {}
    for key, text in sorted(rows):
        w = words(text)
        gone = set()
        for s in range(len(w) - width + 1):
            window = tuple(w[s : s + width])
            if window in seen:
                gone.update(range(s, s + width))
            seen.add(window)
        out[key] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("chunk_words", [500, substring.CHUNK_WORDS])
def test_substrings_match_plain_search(spark, texts, chunk_words):
    got = collected(substring.dedup_documents(documents(spark, texts), chunk_words=chunk_words))
    want = plain_removal(list(enumerate(texts)))
    assert {i: (r["n_words"], r["n_removed"], " ".join(words(r["text"]))) for i, r in got.items()} == want
    assert sum(w[1] for w in want.values()) > 500
    assert all(got[i]["text"] == texts[i] for i in got if not got[i]["n_removed"])


def test_shards_of_near_copies_are_cut(spark):
    rnd = random.Random(6)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(300)]
    texts = []
    for _ in range(60):
        copy = list(base)
        for _ in range(3):
            copy[rnd.randrange(300)] = f"v{rnd.randrange(40)}"
        texts.append(" ".join(copy))
    docs = documents(spark, texts, 6)
    whole = docs.select(*substring.identity("doc_id", "text"), F.col("text").cast("binary").alias("raw"), F.struct("doc_id").alias("row"))
    places = substring.named_places(substring.scan_chunks(whole, 20, 8, 1500), 20, 1000)
    routed = substring.stretches_of(whole, places, 20).groupBy("ref_doc", "ref_sum", "part").agg(F.sum(F.length("words") / 8).alias("n"))
    sizes = sorted(r["n"] for r in routed.collect())
    assert sum(sizes) > 5000 and sizes[-1] < sum(sizes) / 4 and sizes[-1] < 2000
    got = [collected(substring.dedup_documents(docs, chunk_words=1500, shard_words=n)) for n in (1000, 10**9)]
    assert {i: r["text"] for i, r in got[0].items()} == {i: r["text"] for i, r in got[1].items()}
    assert sum(r["n_removed"] for r in got[0].values()) > 10000


@pytest.mark.parametrize("shard_words", [30, 400])
def test_cut_shards_match_plain_search(spark, texts, shard_words):
    got = collected(substring.dedup_documents(documents(spark, texts), chunk_words=500, shard_words=shard_words))
    whole = collected(substring.dedup_documents(documents(spark, texts)))
    assert {i: (r["text"], r["n_removed"]) for i, r in got.items()} == {i: (r["text"], r["n_removed"]) for i, r in whole.items()}


def test_substrings_of_small_alphabets(spark):
    rnd = random.Random(5)
    bases = [[str(rnd.randint(0, 3)) for _ in range(60)] for _ in range(5)]
    rows = []
    for i in range(120):
        b = list(rnd.choice(bases))
        b[rnd.randrange(60)] = str(rnd.randint(0, 9))
        rows.append((i, " ".join(b[rnd.randint(0, 20) : rnd.randint(25, 60)] * rnd.choice([1, 2]))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = collected(substring.dedup_documents(df, chunk_words=200))
    assert {i: (r["n_words"], r["n_removed"], r["text"].strip()) for i, r in got.items()} == plain_removal(rows)


def test_substrings_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substring.dedup_documents(empty).collect() == []
    long = " ".join(map(str, range(30)))
    rows = [(2, long, 1), (2, long, 2), (None, long, 3), (5, None, 4), (1, "a  b\nc ", 5)]
    got = substring.without_repeats(spark.createDataFrame(rows, "doc_id long, text string, begin int"))
    assert got.columns == ["doc_id", "text", "begin"]
    assert sorted(((r["begin"], r["text"]) for r in got.collect())) == [(1, long), (2, long), (3, ""), (4, None), (5, "a  b\nc ")]


def test_automaton_finds_earlier_windows():
    rnd = random.Random(1)
    for _ in range(200):
        automaton, seen = substring.Automaton(), set()
        for _ in range(4):
            text = [rnd.randint(1, 2) for _ in range(rnd.randint(4, 25))]
            want = []
            for s in range(len(text) - 3):
                if tuple(text[s : s + 4]) in seen:
                    want.append(s)
                seen.add(tuple(text[s : s + 4]))
            assert sorted(set(substring.stream_shard(automaton, text, 4))) == want


# Quality rules.


def plain_quality(text):
    w = words(text)
    found = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if found[tuple(w[i : i + 8])] > 1 for k in range(8)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed


def test_quality_counts_match_plain_rules(spark, texts):
    got = collected(quality.judge(documents(spark, texts)))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert {i: tuple(r[c] for c in names) for i, r in got.items()} == {i: plain_quality(t) for i, t in enumerate(texts)}
    assert not any(r["kept"] and r["base_failed"] for r in got.values())


def test_frequent_lines_deplete_all_but_the_first(spark):
    rnd = random.Random(2)
    own = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    footer = own(40)
    texts = [f"{own(5)}\n  {footer.upper()}" if i % 2 else f"{own(60)}\n{footer}" for i in range(30)]
    rows = [(i, t, "h") for i, t in enumerate(texts)] + [(100 + i, f"{own(5)}\n{footer}", "other") for i in range(5)]
    got = collected(quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    # Short documents of the host lose the line; the first one keeps it, as does a host where it is rare.
    assert [i for i, r in got.items() if not r["kept"]] == [i for i in got if i < 30 and i % 2]
    assert got[0]["lost_words"] == 0 and got[2]["lost_words"] == 40


def test_frequent_lines_are_removed_from_the_text(spark):
    rnd = random.Random(5)
    own = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    first = [own(30) for _ in range(30)]
    rows = [(i, f"{t}\n \n  All\tRIGHTS  are ours \nend {i}", "h", 0) for i, t in enumerate(first)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    got = collected(quality.keep_documents(docs))
    assert got[0]["text"] == rows[0][1] and got[0]["n_chars"] == 0
    want = {i: f"{first[i]}\n \nend {i}" for i in range(1, 30)}
    assert {i: (got[i]["text"], got[i]["n_chars"]) for i in want} == {i: (t, len(t)) for i, t in want.items()}
    # A share of 5 % is never reached on a large host; a number of documents is.
    more = docs.unionByName(spark.createDataFrame([(100 + i, own(30), "h", 0) for i in range(700)], docs.schema))
    assert collected(quality.keep_documents(more))[1]["text"] == rows[1][1]
    assert collected(quality.keep_documents(more, quality.QualityParams(max_line_docs=20)))[1]["text"] == want[1]


def test_rows_that_are_stored_twice_lose_words_once(spark):
    rnd = random.Random(7)
    own = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    footer = own(15)
    rows = [(i, f"{own(30)}\n{footer}", "h") for i in range(20)]
    got = quality.judge(spark.createDataFrame(rows + rows[5:] + rows[5:], "doc_id long, text string, source string")).collect()
    assert len(got) == 50 and all(r["kept"] and r["lost_words"] == (15 if r["doc_id"] else 0) for r in got)


def test_copies_do_not_make_lines_frequent(spark):
    rnd = random.Random(3)
    text = "\n".join(" ".join(f"w{rnd.randrange(10**6)}" for _ in range(30)) for _ in range(4))
    rows = [(i, text, "h") for i in range(50)]
    assert all(r["kept"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())


def test_quality_of_odd_tables(spark, texts):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.judge(empty).collect() == [] and quality.keep_documents(empty).columns == empty.columns
    twice = documents(spark, texts[:40]).unionByName(documents(spark, texts[:40]))
    assert quality.judge(twice).count() == 80
    clashing = documents(spark, texts).withColumn("n_words", F.lit(1)).withColumn("_text", F.lit("x"))
    assert quality.keep_documents(clashing).columns == clashing.columns


def test_quality_runs_no_python(spark, texts):
    plan = quality.judge(documents(spark, texts))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Personal data.

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), m.end(), "email") for m in EMAIL.finditer(t)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), m.end(), "card") for m in CARD.finditer(t) if 14 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(t) if 10 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans_match_patterns():
    rnd = random.Random(3)
    parts = list("a.@-+ ()1234567890%_é") + ["a@b.c", "1.2.3.4", "4111111111111111", "+1 (555) 123-4567", "255", "at", "dot"]
    for _ in range(20000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30)))
        assert [s[:3] for s in pii.spans_of(t) if not s[3]] == plain_spans(t), t


@pytest.mark.parametrize(
    "text,found,kind",
    [
        ("write to john [at] example [dot] com now", "john [at] example [dot] com", "email"),
        ("john dot smith at mail dot example dot com", "john dot smith at mail dot example dot com", "email"),
        ("a(at)b(dot)org", "a(at)b(dot)org", "email"),
        ("jоhn@exаmple.com", "jоhn@exаmple.com", "email"),
        ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email"),
        ("call +１ ５５５ １２３ ４５６７", "+１ ５５５ １２３ ４５６７", "phone"),
        ("call plus one five five five one two three four five six seven now", "plus one five five five one two three four five six seven", "phone"),
        ("host 192[.]168[.]1[.]1 is up", "192[.]168[.]1[.]1", "ip"),
        ("four one one one one one one one one one one one one one one two", None, None),
        ("four " + "one " * 15 + "x", "four " + ("one " * 15).strip(), "card"),
    ],
)
def test_disguises_map_back_to_the_source(text, found, kind):
    spans = [s for s in pii.spans_of(text) if s[3]]
    if found is None:
        assert spans == []
    else:
        assert [(text[a:b], k) for a, b, k, _ in spans] == [(found, kind)]


@pytest.mark.parametrize(
    "text,found,kind",
    [
        ("host one nine two dot one six eight dot zero dot one is up", "one nine two dot one six eight dot zero dot one", "ip"),
        ("ten dot no, one zero [dot] 0 [dot] zero [dot] seven yes", "one zero [dot] 0 [dot] zero [dot] seven", "ip"),
        ("see one nine two.one six eight.1.one", "one nine two.one six eight.1.one", "ip"),
        ("call +1 555 one two three 4567 now", "+1 555 one two three 4567", "phone"),
        ("call +1 (555) one 23 4567 now", "+1 (555) one 23 4567", "phone"),
        ("call plus 1 555 123 four 567 now", "plus 1 555 123 four 567", "phone"),
        ("call 555 one two three 4567 now", "555 one two three 4567", "phone"),
        ("card 4111 1111 1111 11 one one ok", "4111 1111 1111 11 one one", "card"),
    ],
)
def test_short_spelled_parts_are_judged_with_their_neighbours(text, found, kind):
    assert [(text[a:b], k) for a, b, k, new in pii.spans_of(text) if new] == [(found, kind)]


@pytest.mark.parametrize("text", ["one dot two dot three", "nine nine nine dot one dot one dot one", "in 1999 two of 2000 and three 2001", "version 4 one 2 two"])
def test_runs_that_are_nothing_stay(text):
    assert pii.spans_of(text) == []


@pytest.mark.parametrize("text", ["look at example.com and dot it", "we met at the red dot com", "one two three go", "она сказала да", "naïve café", "at 10.30 I met two or three"])
def test_clean_text_has_no_spans(text):
    assert pii.spans_of(text) == []


def test_masking(spark):
    rows = [(1, "mail a@b.cd or +1 555 123 4567.", 5, "x"), (2, None, None, "y"), (3, "", 0, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string")
    got = collected(pii.mask_documents(df))
    assert got[1]["text"] == "mail [EMAIL] or [PHONE]." and got[1]["n_chars"] == 24 and got[1]["spans"] == "x"
    assert got[2]["text"] is None and got[3]["text"] == ""
    assert pii.mask_documents(df.limit(0)).collect() == []


def test_span_digests(spark, texts):
    texts = [*texts, "a@b.c 1.2.3.4 +1 555 123 4567", "x at y dot com"]
    got = collected(pii.digests(pii.find_spans(documents(spark, texts))))
    for i, t in enumerate(texts):
        base = plain_spans(t or "")
        line = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert got[i]["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in base) for k in pii.KINDS]


# Tokens.


def test_only_letters_a_to_z_are_lowered_in_lines(spark):
    odd = [" A\u00c9 \tBC\x0b", "\u0130Z", "\u212aK  \u03a3", "Plain TEXT ", "\x1cQ", "\u1e9e", " \t", "[\\]^_`{|}~"]
    rows = spark.createDataFrame([("\n".join(odd),)], "text string").select(quality.lines_of(F.col("text")))
    plain = [re.sub(r"[\x20\x09\x0B-\x0D]+", " ", x).translate({c: c + 32 for c in range(65, 91)}).strip(" ") for x in odd]
    assert rows.first()[0] == [x for x in plain if x]
    counts = quality.judge(documents(spark, ["#*$ %&|<> \u00a3 \\ [ ]", " \t\x0b#\r\n\n$$"])).collect()
    assert sorted((r["doc_id"], r["n_symbols"], r["word_chars"]) for r in counts) == [(0, 8, 12), (1, 3, 3)]


def test_quality_hashes_a_text_once_and_not_per_line(spark, texts):
    """The rows of the lines do not carry the text, and no whole text is looked up character by character."""
    lean = documents(spark, texts).select("doc_id", "text", "source")
    plans = [quality.frequent_lines(lean, quality.QualityParams(), "doc_id", "text", "source"), quality.judge(lean)]
    todo, lines = [p._jdf.queryExecution().optimizedPlan() for p in plans], 0
    assert not any(re.search(r"translate\((coalesce\()?(text|_body|regexp_replace)", p.toString()) for p in todo)
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Generate":
            lines += 1
            assert {node.output().apply(i).name() for i in range(node.output().size())}.isdisjoint(["text", "_body"])
    assert lines == 2


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def test_automaton_matches_the_library(tokenizer):
    rnd = random.Random(1)
    parts = ["a", "b", "th", "e", "ing", "'s", "'ll", "1", "23", "é", "É", "é", "ß", "Σ", "İ", "中", "!", "$$", "😀", "\xa0", "\x1c",
             "<|endoftext|>", "<|start", " ", "\n", "\x0b", "aaaa", "ſ", "ﬁ", "\r\n", "_", "\x85", "​", "ΑΣ "]
    automaton = bpe.Automaton(bpe.compile_automaton(VOCABULARY))
    ids_of = packing.Ids(open(VOCABULARY, encoding="utf-8").read())
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert automaton.encode(text) == want, text
        assert automaton.decode(want) == tokenizer.decode(want, skip_special_tokens=False)
        assert np.frombuffer(ids_of.of(text.encode()), "<u4").tolist() == want, text
    for _ in range(4000):
        word = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(1, 25)))
        assert automaton.path(word) == tokenizer.encode(word, add_special_tokens=False).ids, word


def test_tables_of_seen_texts_are_bounded_in_the_pipeline(spark, texts, monkeypatch):
    """A worker keeps them after its task, beside a JVM whose heap other stages have filled."""
    import corpus_pipeline

    ids_of = packing.Ids(open(VOCABULARY, encoding="utf-8").read(), 20_000, 10_000)
    rnd = random.Random(4)
    words_ = ["".join(rnd.choice("abcdefghij") for _ in range(9)) for _ in range(3000)]
    held = lambda seen: sum(packing.ENTRY_BYTES + len(k) + len(v) for part in (seen, seen.older) for k, v in part.items())
    plain = packing.Ids(open(VOCABULARY, encoding="utf-8").read())
    for word in words_:
        assert ids_of.of(word.encode()) == plain.of(word.encode())
        assert held(ids_of.known) < 21_000 and held(ids_of.words) < 11_000
    pack, asked = packing.pack_documents, []
    monkeypatch.setattr(packing, "pack_documents", lambda *a, **k: asked.append(k["seen_bytes"]) or pack(*a, **k))
    got = corpus_pipeline.packed(spark, documents(spark, texts), "").collect()
    monkeypatch.undo()
    assert sum(asked[0]) <= 160 << 20
    assert sorted(got) == sorted(packing.digests(packing.pack_documents(documents(spark, texts), VOCABULARY)).collect())


def test_a_worker_that_drops_the_broadcast_frees_the_tables():
    state = {"spec": open(VOCABULARY, encoding="utf-8").read(), "bytes": (1 << 20, 1 << 20)}
    gc.disable()
    try:
        ids_of = packing.Ids.of_worker(state)
        assert ids_of is packing.Ids.of_worker(state) and ids_of.of(b"some words") and len(ids_of.known) == 2
        left = [weakref.ref(ids_of), weakref.ref(ids_of.known), weakref.ref(ids_of.words)]
        del ids_of, state
        assert [r() for r in left] == [None] * 3
    finally:
        gc.enable()


def test_encoded_documents(spark, texts, tokenizer):
    docs = documents(spark, texts)
    got = collected(bpe.digests(bpe.encode_documents(docs, VOCABULARY)))
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert tuple(got[i])[1:] == (len(ids), bpe.sha256(" ".join(map(str, ids))), bpe.sha256(decoded)), t
    back = collected(bpe.decode_rows(bpe.encode_documents(docs, VOCABULARY), VOCABULARY))
    direct = collected(bpe.encode_documents(docs, VOCABULARY))
    assert all(back[i]["text"] == direct[i]["decoded"] for i in back)
    assert bpe.encode_documents(docs.limit(0), VOCABULARY).collect() == []


def best_split(scores, word):
    best = [(0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for begin in range(end):
            if (s := scores.get(word[begin:end])) is not None:
                cell = (best[begin][0] + s, best[begin][1] - 1)
                best[end] = max(best[end], cell) if best[end] else cell
    return -best[-1][1]


def test_token_counts(spark, texts):
    import regex

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    scores = tokencount.piece_scores(path)
    got = collected(tokencount.count_tokens(documents(spark, texts), path, public_tokenizers.PATTERN))
    for i, t in enumerate(texts):
        parts = [p.encode() for p in regex.findall(public_tokenizers.PATTERN, t or "")]
        if max(map(len, parts), default=0) < 200:
            assert tuple(got[i])[1:] == (len(parts), sum(best_split(scores, p) for p in parts)), t


# Packing.


def check_pieces(rows, window):
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        documents[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == window or at < window and at & (at - 1) == 0
    for pieces in documents.values():
        at = 0
        for start, length, total in sorted(pieces):
            assert start == at and length > 0
            at += length
        assert at == total


@pytest.mark.parametrize("window,pool", [(2048, packing.POOL_TOKENS), (64, 1000)])
def test_packing(spark, texts, tokenizer, window, pool):
    rows = packing.pack_documents(documents(spark, texts), VOCABULARY, window=window, pool_tokens=pool).collect()
    check_pieces(rows, window)
    ids = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["start"]):
        ids[r["doc_id"]] += np.frombuffer(r["ids"], "<u4").tolist()
    want = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    assert ids == want


@pytest.mark.parametrize("lengths", [[1500] * 300, [1] * 500, [2048, 4096, 1], [700, 1400, 1100] * 100, []])
def test_packer_without_padding(lengths):
    packer = packing.Packer(2048, 0)
    for i, n in enumerate(lengths):
        packer.add((i, n), bytes(4 * n))
        packer.settle(100_000)
    packer.finish()
    check_pieces([dict(doc_id=r[0], doc_tokens=r[1], start=s, length=len(b) // 4, sequence_id=q, offset=o) for r, s, b, q, o in packer.out], 2048)
    assert sum(len(p[2]) for p in packer.out) == 4 * sum(lengths)


def sums_within(items, room):
    """All sums up to `room` of some of the items."""
    sums = {0}
    for item in items:
        sums |= {s + item for s in sums if s + item <= room}
    return sums


def test_fill_takes_the_closest_sum_and_uses_what_is_there():
    rnd = random.Random(6)
    counts = Counter(rnd.randint(1, 100) for _ in range(500))
    total, left, windows, cuts = sum(k * v for k, v in counts.items()), dict(counts), 0, 0
    for chosen, spare, times in packing.fill(left, 100):
        longest, *others = chosen
        assert longest == max(k for k, v in counts.items() if v)
        counts[longest] -= 1
        assert sum(others) == max(sums_within(counts.elements(), 100 - longest))
        counts[longest] += 1
        for length in chosen:
            counts[length] -= times
        slack = 100 - sum(chosen)
        assert bool(slack) == bool(spare) and min(counts.values()) >= 0
        if slack:
            assert times == 1 and spare == max(k for k, v in counts.items() if v) and spare > slack
            counts.update({spare - slack: 1})
            counts[spare] -= 1
        windows, cuts = windows + times, cuts + bool(spare)
    assert {k: v for k, v in counts.items() if v} == {k: v for k, v in left.items() if v}
    assert windows == total // 100 and sum(k * v for k, v in left.items()) == total % 100
    assert cuts < 0.4 * windows  # 184 of these lengths have a partner that fills the window with them


def test_kept_ids_are_bounded():
    seen = packing.Seen(lambda text: text * 2, 2000)
    for i in range(100):
        assert seen[b"%d" % i] == b"%d%d" % (i, i) and len(seen) <= 6 and len(seen.older) <= 6
    assert seen[b"98"] == b"9898" and seen[b"x" * 65] == b"x" * 130 and b"x" * 65 not in seen


def test_piece_digests(spark, texts):
    pieces = packing.pack_documents(documents(spark, texts), VOCABULARY, window=64)
    raw = {(r["doc_id"], r["start"]): zlib.crc32(r["ids"]) for r in pieces.collect()}
    assert {(r["doc_id"], r["start"]): r["ids_crc32"] for r in packing.digests(pieces).collect()} == raw
    assert packing.pack_documents(documents(spark, texts).limit(0), VOCABULARY).collect() == []


def test_queries_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLE) <= set(queries.QUERIES)


CLASHING = "doc_id long, text string, source string, kept string, lost_words string, n_words string, _gone string, _row int, _key int, n_removed int"


def test_columns_of_any_name(spark):
    """What an operator adds replaces a column of its name; a stage keeps all columns as they are."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(30)), "a", "k", "l", "n", "g", 1, 2, 3) for i in range(3)] + [(3, None, None, "k", "l", "n", "g", 1, 2, 3)]
    rows.append((4, rows[0][1], "a", "k", "l", "n", "g", 1, 2, 3))
    docs = spark.createDataFrame(rows, CLASHING)
    judged = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert judged[0]["kept"] is True and judged[3]["kept"] is False and judged[0]["n_words"] == 30 and judged[0]["_gone"] == "g"
    assert quality.judge(docs).columns.count("kept") == 1
    assert sorted(quality.keep_documents(docs).collect()) == sorted(r for r in docs.collect() if r["doc_id"] != 3)
    assert minhash.one_of_each(docs).columns == docs.columns
    assert {tuple(r) for r in minhash.one_of_each(docs).collect()} == {r for r in rows if r[0] != 4}
    cut = {r["doc_id"]: r for r in substring.dedup_documents(docs).collect()}
    assert cut[4]["n_removed"] == 30 and cut[0]["n_words"] == 30 and cut[0]["_gone"] == "g"
    assert substring.without_repeats(docs).columns == docs.columns


@pytest.mark.parametrize("percent", [80, 85])
def test_filters_of_near_duplicates_lose_nothing(percent):
    """Pairs at the threshold, of equal and of unequal sizes."""
    rng = np.random.default_rng(percent)
    for size in (30, 64, 70, 100, 500, 3000):
        for _ in range(150):
            shared = -(-size * percent // 100)
            extra = int(rng.integers(0, size - shared + 1))  # of the first set; the second has the rest of the union
            values = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            a, b = np.sort(values[: shared + extra]), np.sort(np.r_[values[:shared], values[shared + extra :]])
            assert minhash.likely([a, b], minhash.RETAINED, percent / 100)[0, 1]
            for s in (a, b):
                sketch = s[: minhash.RETAINED]
                assert 2 * len(np.intersect1d(a[: minhash.RETAINED], b[: minhash.RETAINED])) >= len(sketch)


def test_blocks_are_bounded_by_sets(spark):
    """Many short texts with one shared beginning: a block holds about 1,000 of them, however few their shingles."""
    rows = [(i, f"thank you for visiting page x{i // 2}") for i in range(3000)]
    got = {r["doc_id"]: r for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i]["component_id"] == i - i % 2 for i in range(3000))
