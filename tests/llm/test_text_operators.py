"""Each operator against a plain version of its contract, over odd rows and a test table."""
import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from tests.llm import plain_lm
from tests.llm.conftest import by_id, odd_rows
from tillwork.llm import bpe, langid, licenses, lines, lm, mixing, quality, sharding, simhash

W = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module", params=["odd", "documents"])
def table(request):
    return request.getfixturevalue(request.param)


def test_base_measures(table):
    def plain(doc_id, text):
        text = text or ""
        words = W.findall(text)
        grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
        cover = {k for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for k in range(i, i + 8)}
        lines_ = [x for x in text.split("\n") if W.search(x)]
        n = len(words)
        return (doc_id, n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines_) - len(set(lines_)),
                len(cover), n < 20 or 100 * len(cover) > 30 * n)

    got = quality.assess(table)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    want = sorted([plain(*r) for r in texts_of(table)], key=lambda t: [(x is not None, x) for x in t])
    assert by_id(got, *columns) == want
    assert not got.where("base_failed AND kept").count()


def test_divergence_bounds():
    p, q = np.array([0.5, 0.5, 0.0]), np.array([[0.5, 0.5, 0.0], [0.0, 0.0, 1.0]])
    assert quality.divergence(p, q) == pytest.approx([0, 1])


def test_verdict_follows_labels(spark):
    from tillwork.llm.common import table
    sf = "/root/testdata/sf0.01"
    got = quality.assess(table(spark, sf, "documents")).join(table(spark, sf, "labels"), "doc_id")
    rates = {r["quality"]: r["k"] for r in got.groupBy("quality").agg({"kept": "count"}).withColumnRenamed("count(kept)", "k").collect()}
    kept = {r["quality"]: r["count"] for r in got.where("kept").groupBy("quality").count().collect()}
    assert kept[1] / rates[1] > 0.94 and kept.get(0, 0) / rates[0] < 0.3


def test_texts_without_common_words_go(spark):
    """Random letters, lists of keys and shuffled letters; what is clean stays."""
    from tillwork.llm.common import table
    rng = np.random.default_rng(4)
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang", "text")
    letters = list("abcdefghijklmnopqrstuvwxyz")
    word = lambda: "".join(rng.choice(letters, int(rng.integers(2, 10))))
    prose = [r["text"] for r in quality.assess(docs).where("kept AND n_words > 100").join(docs, "doc_id").select("text").limit(30).collect()]
    shuffle = lambda t: " ".join("".join(rng.permutation(list(w))) for w in t.split() if len(w) > 3)
    bad = [" ".join(word() for _ in range(300)) for _ in range(30)]
    bad += [", ".join(f"{word()}-{word()}: {word()}" for _ in range(80)) for _ in range(30)] + [shuffle(t) for t in prose]
    made = [(-i, None, t) for i, t in enumerate(bad, 1)]
    found = quality.assess(docs.union(spark.createDataFrame(made, docs.schema)))
    assert found.where("doc_id < 0 AND kept").count() == 0


def test_nearest_reference_by_hand(documents):
    """Distances and shares of each document from counts of its words and classes."""
    refs = quality.references(documents)
    for r in quality.assess(documents).join(documents.select("doc_id", "text"), "doc_id").collect():
        words = W.findall((r["text"] or "").translate(LOWER))
        best = []
        for k, lang in enumerate(refs.langs):
            p = [words.count(w.decode()) for w in refs.words[k]]
            p, q = [*p, len(words) - sum(p)], refs.shares[k]
            js = sum(x * math.log2(2 * x / (x + y)) for a, b in ((np.array(p) / max(len(words), 1), q),
                     (q, np.array(p) / max(len(words), 1))) for x, y in zip(a, b) if x > 0) / 2
            best.append((math.sqrt(max(js, 0)), sum(p[:-1]) / max(len(words), 1) / (1 - q[-1])))
        if r["word_divergence"] is not None:
            assert any(r["word_divergence"] == pytest.approx(d, abs=1e-6) and
                       (r["common_share"] is None or r["common_share"] == pytest.approx(c)) for d, c in best)
        if r["kept"]:
            assert not r["base_failed"] and (r["common_share"] is None or r["common_share"] >= 0.25)


def test_license_places(spark, table):
    words = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    extra = spark.createDataFrame([(900, "Under the\nMIT-License, under the mit license"), (901, "cc by nc nd CC BY-NC 4.0"),
                                   (902, "apache license version 2 apache license version 20")], "doc_id long, text string")
    table = table.select("doc_id", "text").union(extra)
    phrases = {k: v.split() for k, v in licenses.PHRASES.items()}

    def plain(doc_id, text):
        ws = words.findall((text or "").translate(LOWER))
        found = [(label, i) for label, p in phrases.items() for i in range(len(ws)) if ws[i:i + len(p)] == p]
        at = [i for _, i in found]
        return (doc_id, len(ws), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for x, _ in found})))

    got = licenses.digest(licenses.scan(table))
    want = sorted([plain(*r) for r in texts_of(table)], key=lambda t: [(x is not None, x) for x in t])
    assert by_id(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
    for r in got.collect():
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1


def test_containment_join_finds_all(spark):
    """Every block at every word against every template by counting sets."""
    rng = np.random.default_rng(3)
    sets = [(label, licenses.words_of(t)) for label, t in licenses.TEMPLATES]
    vocabulary = sorted({w for _, t in sets for w in t}) + [b"alpha", b"beta", b"gamma"]
    docs = []
    for i in range(90):
        words = list(rng.choice(vocabulary, int(rng.choice([0, 4, 120]))))
        at = int(rng.integers(0, len(words) + 1))
        words[at:at] = [w for w in sets[i % len(sets)][1] if rng.random() < 0.93]
        docs.append((i, b" ".join(words).decode()))
    docs.append((90, ", ".join(t for _, t in licenses.TEMPLATES)))
    docs.append((91, "all rights reserved " * 50))
    for threshold in (0.7, 0.85):
        for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string"), threshold=threshold).collect():
            words, want = licenses.words_of(dict(docs)[r["doc_id"]]), []
            for label, t in sets:
                width, run = len(t) + int((1 - threshold) * len(t) + 1e-9), None
                for s in range(max(1, len(words) - width + 1)):
                    c = len(set(words[s:s + width]) & set(t)) / len(set(t))
                    if c < threshold - 1e-9:
                        run = None
                    elif run is None:
                        run = [label, s, min(len(words), s + width), c]
                        want.append(run)
                    else:
                        run[2:] = [s + width, max(c, run[3])]
            assert sorted([b["label"], b["start"], b["end"], b["containment"]] for b in r["blocks"]) == sorted(want)


def test_licenses_side_by_side(spark):
    bsd = "All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted"
    cases = {bsd: "all-rights-reserved,bsd", bsd.replace("binary", "other"): "all-rights-reserved,bsd",
             "licensed under the apache license version 2 0 or released under the mit license": "apache-2,mit",
             "this work is licensed under the gnu general public license version 2": "gpl-2",
             "Licensed under CC BY-NC 4.0": "cc-by-nc",
             "we are licensed by the city under section 2 of the version 0 license and apache people came": ""}
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    assert by_id(licenses.digest(licenses.scan(docs)), "doc_id", "labels") == list(enumerate(cases.values()))


def test_tokens_as_tiktoken(table):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
        base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))})

    def plain(doc_id, text):
        ids = coder.encode_ordinary(text or "")
        return (doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest())

    got = bpe.tokenize(table, keep_ids=True)
    want = sorted([plain(*r) for r in texts_of(table)], key=lambda t: [(x is not None, x) for x in t])
    assert by_id(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert all(len(r["ids"]) == r["n_tokens"] for r in got.collect())


def test_replay_of_odd_pieces():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.ranks(path)
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=ranks)
    every = ["".join(map(chr, range(1, 0x3000))), "a" * 5000, "ab" * 999 + "!" * 77, "   \n\n   x\x85y \x1c z", "aaab" * 50, "<|endoftext|>"]
    encoder = bpe.Encoder(path, public_tokenizers.PATTERN)
    assert [list(map(int, ids.split())) for ids, _ in encoder.encode(every)] == [coder.encode_ordinary(t) for t in every]


def test_shards(spark, table):
    got = sharding.place(table, rows_per_chunk=5).collect()
    assert len(got) == table.count()
    crc = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)
    assert crc == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts_of(table))
    for s in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert {r["law"] for r in got} == {"key"} and all(r["grown_shard"] in (r["shard"], 8) for r in got)
    assert len({(r["doc_id"], r["shard"], r["grown_shard"]) for r in got}) == len({r["doc_id"] for r in got})


def test_tree_moves_stay_inside(spark):
    """A heavier shard only draws rows into its own region, rack and itself at each level."""
    ids = spark.range(4000)
    heavy = {**sharding.EIGHT, "r1": {**sharding.EIGHT["r1"], "k0": {4: 3.0, 5: 1.0}}}
    key = ids["id"].cast("string")
    rows = sharding.assign(sharding.assign(ids, key, sharding.EIGHT, "a"), key, heavy, "b").collect()
    moved = [(r["a"], r["b"]) for r in rows if r["a"] != r["b"]]
    assert moved and all(b >= 4 for _, b in moved)
    assert all(b in (4, 5) for a, b in moved if a in (6, 7)) and all(b == 4 for a, b in moved if a == 5)
    share = Counter(r["b"] for r in rows)
    assert share[4] / 4000 == pytest.approx(0.3, abs=0.04)


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > cap * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in open_}
        for s in over:
            target[s] = float(cap * sizes[s])
            left -= target[s]
        open_ -= over
    return target


def test_mix(table):
    got = mixing.mix(table, docs_per_shard=7).collect()
    sizes = Counter()
    for r in table.collect():
        sizes[r["source"]] += len(W.findall(r["text"] or ""))
    target = plain_targets(dict(sizes))
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, len(W.findall(t or ""))) for i, t in texts_of(table))
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.02 * t + 2
    again = mixing.mix(table.repartition(3), docs_per_shard=7)
    assert by_id(again, "doc_id", "size", "taken") == sorted(
        [(r["doc_id"], r["size"], r["taken"]) for r in got], key=lambda t: [(x is not None, x) for x in t])


def test_sainte_lague(spark):
    rng = np.random.default_rng(5)
    for votes, seats in [([53, 24, 23], 7), ([1000, 1, 1, 1, 1, 1, 1], 100), (rng.integers(1, 99, 40).tolist(), 23), ([5, 5, 5, 5], 6)]:
        held = [0] * len(votes)
        for _ in range(seats):
            k = max(range(len(votes)), key=lambda i: (votes[i] / (2 * held[i] + 1), -i))
            held[k] += 1
        parties = spark.createDataFrame([(i, float(v), seats) for i, v in enumerate(votes)], "p int, v double, s long")
        assert [n for _, n in by_id(mixing.apportion(parties, [], "p", "v", "s", "n"), "p", "n")] == held


def plain_print(text):
    words = W.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(table):
    rows = texts_of(table)
    prints = [plain_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[find(i)] = min(doc_id, smallest.get(find(i), doc_id))
    want = [(doc_id, f"{p:016x}", smallest.get(find(i))) for i, ((doc_id, _), p) in enumerate(zip(rows, prints))]
    assert by_id(simhash.classes(table), "doc_id", "fingerprint", "component_id") == sorted(
        want, key=lambda t: [(x is not None, x) for x in t])


def test_pigeonhole_finds_all_pairs(spark):
    """Correlated bits, and sizes at which the plan takes other thresholds."""
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    values = {int(b) ^ sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 6), replace=False)) for b in base for _ in range(12)}
    values |= {0, 1, 3, 7, 15, 31, 2 ** 64 - 1}
    fps = spark.createDataFrame([(simhash._signed(v),) for v in values], "_fp long")
    want = {tuple(sorted((simhash._signed(a), simhash._signed(b)))) for a in values for b in values
            if a < b and (a ^ b).bit_count() <= 4}
    got = [tuple(r) for r in simhash.close_pairs(fps).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    both = simhash._bit_counts(fps)
    for n in (10 ** 3, 10 ** 6, 10 ** 8, 10 ** 10):
        parts = simhash.plan(both / len(values) * n, n)
        assert sum(p.threshold + 1 for p in parts) == 5  # thresholds of all parts add up to most - parts + 1
        assert not any(a.mask & b.mask for a in parts for b in parts if a is not b)


def test_languages(documents):
    got = langid.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert held and sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


def test_languages_of_odd_rows(odd):
    got = {r["doc_id"]: r for r in langid.identify(odd).collect()}
    for doc_id in (100, 101, 104, 105):
        assert (got[doc_id]["lang_pred"], got[doc_id]["score"]) == ("und", 0)
    assert got[102]["lang_pred"] == "de" and all(0 <= r["score"] <= 1 for r in got.values())


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba"]
    lattice = langid.Lattice(pieces)
    prob = np.array([[0.2], [0.1], [0.3], [0.15], [0.05], [0.2], [0.0], [langid.UNSEEN]])
    p = dict(zip(pieces, prob[:, 0]))

    def total(word):
        return 1.0 if not word else sum(p.get(word[:k], langid.UNSEEN if k == 1 else 0) * total(word[k:])
                                        for k in range(1, len(word) + 1))

    for word in ("a", "abab", "bbaabz", "zz"):
        (_, ids, spans), = lattice.by_length([word])
        got = langid.forward(ids, spans, prob)[0, -1, 0] / 100.0 ** (len(word) + 1)
        assert got == pytest.approx(total("▁" + word))


def test_scores(table):
    rows = texts_of(table)
    tokens = [[*W.findall((t or "").translate(LOWER)), None] for _, t in rows]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for i, _ in rows]
    c = Counter(w for ts, h in zip(tokens, held) if not h for w in ts)
    n, v = sum(c.values()), len(c)
    want = sorted([(i, h, len(ts), sum(c[w] > 0 for w in ts), n) for (i, _), ts, h in zip(rows, tokens, held)],
                  key=lambda t: [(x is not None, x) for x in t])
    got = lm.score(table, block_bytes=100_000)
    assert by_id(got, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens") == want
    base = sorted(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ts) for ts in tokens)
    assert sorted(r["base_score"] for r in got.collect()) == pytest.approx(base)


def test_automaton_is_a_distribution(documents):
    train = documents.where(~lm.held_out(documents["doc_id"]))
    counts, total, distinct, model = plain_lm.learn(train, share=1e-4)
    automaton = plain_lm.Automaton(model, total, distinct)
    known = {bytes(r["word"]): r["c"] for r in counts.collect()}
    number = {lm.END: plain_lm.END_ID} | {w: i + 2 for i, w in enumerate(model.words)}
    norm = total + 0.1 * (distinct + 1)
    for state in [0, 1, 2, 9, len(automaton.fail) - 1]:
        automaton.start = state
        mass = 0.1 / norm + sum(10 ** automaton.score([number.get(w, -1)], [math.log10((n + 0.1) / norm)]) for w, n in known.items())
        assert mass == pytest.approx(1, abs=1e-4)
    # n-grams by counting them all
    sequences = [["<s>", *lm.tokens_of(t or "")] for _, t in texts_of(train)]
    least = max(2, 1e-4 * total)
    for order, (keys, n) in enumerate(model.grams, start=2):
        grams = Counter(tuple(s[i:i + order]) for s in sequences for i in range(len(s) - order + 1))
        assert sorted(n.tolist()) == sorted(x for x in grams.values() if x >= least)


def test_scores_know_all_ngrams_seen_twice(table):
    """Against the automaton in one place that has every n-gram seen twice, walked token by token."""
    _, total, distinct, model = plain_lm.learn(table.where(~lm.held_out(table["doc_id"])), share=0)
    automaton = plain_lm.Automaton(model, total, distinct)
    number = {lm.END: plain_lm.END_ID} | {w: i + 2 for i, w in enumerate(model.words)}
    learned = Counter(w for i, t in texts_of(table.where(~lm.held_out(table["doc_id"]))) for w in lm.tokens_of(t or ""))
    want = []
    for i, text in texts_of(table):
        tokens = lm.tokens_of(text or "")
        logs = [math.log10((learned[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens]
        want.append((i is not None, i, automaton.score([number.get(w, -1) for w in tokens], logs)))
    got = [(r["doc_id"] is not None, r["doc_id"], r["score"]) for r in lm.score(table, block_bytes=20_000, stretch=50).collect()]
    key = lambda r: (r[0], r[1] or 0, r[2])
    want, got = sorted(want, key=key), sorted(got, key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in want], rel=1e-9)


def test_every_language_is_known(spark):
    """70 made-up languages; the last ones have a document each."""
    rng = np.random.default_rng(5)
    ids = iter(i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 != 2)
    docs = []
    for k in range(70):
        words = ["".join(rng.choice(list("abcdefghijklmnoprstuvz"), 7)) for _ in range(30)]
        docs += [(next(ids), " ".join(rng.choice(words, 60)), f"l{k:02}") for _ in range(2 if k < 64 else 1)]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    told = {r["doc_id"]: r["lang_pred"] for r in langid.identify(table).collect()}
    assert told == {i: lang for i, _, lang in docs}
    assert quality.references(table).langs == sorted({lang for _, _, lang in docs})


def test_recurring_lines(spark):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(3000)]
    prose = [" ".join(rng.choice(words, 9)) for _ in range(120)]
    docs = [(i, f"{prose[i]}\nThe user called {rng.choice(words)} logged in from port {rng.integers(1, 9999)} today\n{prose[i + 40]}") for i in range(40)]
    docs += [(50, docs[3][1]), (51, None), (52, ""), (None, docs[5][1])]
    got = {r["doc_id"]: r["text"] for r in lines.keep_first(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[0] == docs[0][1] and got[51] is None and got[52] == ""
    for i in range(1, 40):
        assert got[i] == f"{prose[i]}\n{prose[i + 40]}"
    assert got[50] == got[3] and got[None] == got[5]


def plain_lines(docs, depth=3, short=5, least_texts=10, least_constant=0.6):
    """Texts after line dedup, by going through all lines in order."""
    def tokens_of(line):
        return ["<*>" if re.search("[0-9]", w) else w for w in W.findall(line)]

    texts = {}
    for doc_id, text in docs:
        first = (doc_id is None, doc_id or 0)
        texts[text or ""] = min(first, texts.get(text or "", first))
    ordered = [(t, at, line) for t in sorted(texts, key=texts.get) for at, line in enumerate(t.split("\n"))
               if re.search("[A-Za-z]|[^\x00-\x7f]", line)]
    leaf_of = lambda ts: (len(ts), *(ts if len(ts) < short else ts[:depth]))
    same, recur = {}, {}
    # a token's weight is summed over lines, so a text with two lines of a leaf counts for each
    weight = Counter()
    for ts, t in {(tuple(tokens_of(line)), t) for t, _, line in ordered}:
        for pos, w in enumerate(ts):
            weight[leaf_of(ts), pos, w] += w != "<*>"

    def template(ts):
        fixed = tuple((p, w) for p, w in enumerate(ts) if weight[leaf_of(ts), p, w] >= least_texts)
        return (leaf_of(ts), fixed) if len(fixed) >= least_constant * len(ts) else None

    for t, at, line in ordered:
        same.setdefault(tuple(W.findall(line)), []).append((t, at))
        if (m := template(tuple(tokens_of(line)))) is not None:
            recur.setdefault(m, []).append((t, at))
    gone = {x for found, least in ((same, 2), (recur, least_texts)) for places in found.values()
            if len({t for t, _ in places}) >= least for x in places[1:]}
    return [(d, t if t is None else "\n".join(x for at, x in enumerate(t.split("\n")) if (t, at) not in gone)) for d, t in docs]


def line_cases():
    rng = np.random.default_rng(12)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(900)]
    docs = []
    for i in range(60):
        own = [" ".join(rng.choice(words, int(rng.integers(2, 12)))) for _ in range(4)]
        some = ["All rights reserved.", "版权所有不得转载", "---", "7", f"Page {i} of 60", f"Seen on day {i} by the staff", "",
                f"Order {i % 7} was sent", "the passage of twelve words that only some of the texts here have"]
        own += [x for x in some if rng.random() < (0.2 if x.startswith("the passage") else 0.7)]
        docs.append((i, "\n".join(rng.permutation(own))))
    return docs + [(99, docs[4][1]), (99, docs[4][1]), (None, docs[7][1]), (100, None), (101, "")]


def test_lines_as_by_hand(spark, documents, odd):
    for docs in (line_cases(), texts_of(documents), texts_of(odd)):
        table = spark.createDataFrame(docs, "doc_id long, text string")
        key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
        got = sorted(map(tuple, lines.keep_first(table).select("doc_id", "text").collect()), key=key)
        assert got == sorted(plain_lines(docs), key=key)


def test_short_unspaced_and_rare_lines_go(spark):
    rng = np.random.default_rng(1)
    own = [" ".join("".join(rng.choice(list("klmnop"), 6)) for _ in range(9)) for _ in range(40)]
    docs = [(f"d{i:02}", "\n".join([own[i], "All rights reserved.", "版权所有不得转载",
                                    *(["twelve words stand in this line which eight of all texts have today"] * (i < 8))]))
            for i in range(40)]
    got = {r["doc_id"]: r["text"] for r in lines.keep_first(spark.createDataFrame(docs, "doc_id string, text string")).collect()}
    for line in docs[0][1].split("\n")[1:]:
        assert sum(line in t for t in got.values()) == 1
    assert all(own[i] in got[f"d{i:02}"] for i in range(40))


def test_lines_of_one_text_stay(spark):
    docs = [(i, f"text {chr(97 + i)} is of its own\nsame\nsame\n12\n---" if i < 1 else f"another {chr(97 + i)}\n12\n---") for i in range(20)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert by_id(lines.keep_first(table), "doc_id", "text") == docs


def test_odd_rows_are_what_they_claim(odd):
    assert odd.count() == len(odd_rows())
