"""Operators on documents against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from quillforge.llm import pseudolikelihood, substring
from quillforge.llm.decontaminate import contamination, uncontaminated
from quillforge.llm.neardup import Join, fewest_matches, one_of_each, similarity_join
from quillforge.llm.packing import pack_documents, pack_histogram
from quillforge.llm.quality import keep_good, learn, score_quality
from quillforge.llm.tokens import Counts, Vocabulary, count_tokens, counts_of

SMALL = "/root/testdata/sf0.001"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string"


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# Packing


@pytest.mark.parametrize("seed", range(40))
def test_runs_place_every_piece_once(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 20, 50])
    histogram = collections.Counter(r.randint(1, capacity) for _ in range(r.randint(0, 200)))
    sequences, ranks = collections.defaultdict(list), collections.defaultdict(list)
    for run in pack_histogram(dict(histogram), capacity):
        for k in range(run.count):
            sequences[run.sequence + k // run.per_bin].append((run.offset + k % run.per_bin * run.length, run.length))
            ranks[run.length].append(run.first + k)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    need = -(-sum(k * n for k, n in histogram.items()) // capacity)
    assert need <= len(sequences) <= 11 * need / 9 + 1


def test_dominance_pairs_what_fills_a_sequence():
    assert len({r.sequence for r in pack_histogram({7: 1, 3: 1, 6: 1, 4: 1}, 10)}) == 2
    assert pack_histogram({}, 10) == []


def test_pieces_have_the_tokenizers_ids(spark, awkward):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))
    got = pack_documents(docs, BYTE_BPE).toPandas()
    tokenizer, expected = Tokenizer.from_file(BYTE_BPE), collections.Counter()
    for doc_id, text in docs.collect():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        start, end, piece = 0, len(ids) - (len(ids) - 1) // 1024 * 1024, 0
        while start < len(ids):
            expected[str(doc_id), piece, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())] += 1
            start, end, piece = end, end + 1024, piece + 1
    ids = ["None" if i != i else str(int(i)) for i in got["doc_id"]]
    assert collections.Counter(zip(ids, got["piece"], got["start"], got["length"], got["ids_crc32"], strict=True)) == expected
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert rows["length"].sum() <= 1024
        assert rows["offset"].tolist() == [0, *rows["length"].cumsum().tolist()[:-1]]


def test_packing_nothing(awkward):
    assert pack_documents(awkward.limit(0), BYTE_BPE).count() == 0


# Quality


def test_held_out_documents_are_told_apart(spark, awkward):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    classifier = learn(docs, labels)
    scored = score_quality(docs, classifier).toPandas()
    assert (scored["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored["doc_id"]]).all()
    assert scored["score"].between(0, 1).all() and (scored["predicted"] == (scored["score"] >= 0.3)).all()
    known = scored.merge(labels.toPandas(), on="doc_id").query("held_out")
    assert (known["predicted"] == known["quality"]).mean() > 0.93
    odd = score_quality(awkward, classifier).collect()
    assert len(odd) == awkward.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert keep_good(awkward, classifier).columns == awkward.columns
    assert keep_good(awkward.limit(0), classifier).count() == 0


def test_without_labels_all_scores_are_equal(spark, awkward):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in score_quality(awkward, learn(awkward, none)).collect()} == {0.5}


# Near duplicates


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else None


def brute_links(rows, threshold=0.8):
    """(doc_id, class_id, n_links) of every row."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))
    links = [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(find(k), []).append(i)
    return sorted(((i, min(least[find(k)], key=lambda x: (x is not None, x)), links[k]) for k, (i, _) in enumerate(rows)), key=str)


def near_copies(seed, n=150):
    r, rows = random.Random(seed), []
    bases = [[f"w{r.randint(0, 400)}" for _ in range(r.randint(1, 200))] for _ in range(6)]
    for i in range(n):
        words = list(r.choice(bases))
        for _ in range(r.randint(0, 1 + len(words) // 40)):
            words[r.randrange(len(words))] = f"v{r.randint(0, 9)}"
        rows.append((i, r.choice([" ", "  ", "\n"]).join(words)))
    return rows


@pytest.mark.parametrize("together", [192, 16])
def test_no_link_is_lost(spark, together):
    rows = near_copies(together) + [(900, None), (901, ""), (902, "a b"), (903, "a  b"), (903, "a  b")]
    got = similarity_join(spark.createDataFrame(rows, DOCS).repartition(3), Join(together=together))
    assert rows_of(got, "doc_id", "class_id", "n_links") == brute_links(rows)


def test_one_of_each_class_stays(spark, awkward):
    rows = near_copies(3, 60) + [(1, "z y"), (1, "z y"), (2, None), (3, "")]
    kept = rows_of(one_of_each(spark.createDataFrame(rows, DOCS)), "doc_id", "text")
    classes = {c for i, c, _ in brute_links(rows)}
    assert {i for i, _ in kept} == classes
    assert [k for k in kept if k[1] == "z y"] == [(1, "z y")] and (2, None) in kept and (3, "") in kept
    left = one_of_each(awkward)
    assert left.columns == awkward.columns and left.where("text = 'one'").count() == 1 and left.where("doc_id = 5").count() == 2
    assert one_of_each(awkward.limit(0)).count() == 0


def test_null_ids_inside_groups_of_near_copies(spark):
    rows = [(None if i % 5 == 0 else i, t) for i, t in near_copies(7, 80)]
    rows += [(None, rows[1][1]), (None, rows[2][1]), (None, None)]
    only = " ".join(f"n{k}" for k in range(60))
    rows += [(None, only), (None, only + " m"), (None, "far from all others")]
    got = similarity_join(spark.createDataFrame(rows, DOCS).repartition(3)).toPandas().astype(object)
    # Brute force by row numbers that sort null ids last.
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    expected = [(order[i][0], order[c][0], n) for i, c, n in brute_links([(k, t) for k, (_, t) in enumerate(order)])]
    found = [tuple(None if x is None or x != x else int(x) for x in r) for r in got[["doc_id", "class_id", "n_links"]].itertuples(index=False)]
    assert sorted(found, key=str) == sorted(expected, key=str)
    classes = {c for _, c, _ in brute_links([(k, t) for k, (_, t) in enumerate(order)])}
    assert got["class_key"].nunique() == len(classes) - 1 and got["kept"].sum() == len(classes)
    kept = one_of_each(spark.createDataFrame(rows, DOCS))
    assert kept.count() == len(classes)


def test_pruning_keeps_what_may_reach_the_threshold():
    needed = fewest_matches(Join())
    assert needed[128] < 0.8 * 128 - 5 * (128 * 0.16) ** 0.5 and needed[16] <= 4 and (np.diff(needed) >= 0).all()


# Substring dedup


def brute_passages(rows, n):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words, strict=True):
        for s in range(len(w) - n + 1) if i is not None else ():
            first[tuple(w[s : s + n])] = min(first.get(tuple(w[s : s + n]), i), i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = {p for s in range(len(w) - n + 1) if i is not None and first[tuple(w[s : s + n])] < i for p in range(s, s + n)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    r, rows = random.Random(seed), []
    pool = [[r.choice("abcdefgh") + str(r.randint(0, 9)) for _ in range(40)] for _ in range(8)]
    for i in range(120):
        words = []
        for _ in range(r.randint(0, 5)):
            passage, at = r.choice(pool), r.randint(0, 30)
            words += passage[at : at + r.randint(1, 40)] + [f"z{r.randint(0, 999)}"] * (r.random() < 0.5)
            words += ["x"] * r.choice([0, 0, 0, 30]) + words[:20] * r.choice([0, 0, 1])
        rows.append((r.choice([i, i, i, i, None, i // 2]), r.choice([" ", "\n", "  "]).join(words) or None))
    return rows + rows[:5]


@pytest.mark.parametrize("shard_units", [1000, 2])
def test_passages_against_brute_force(spark, monkeypatch, shard_units):
    monkeypatch.setattr(substring, "SHARD_UNITS", shard_units)
    rows = passages(shard_units)
    got = substring.deduplicated(spark.createDataFrame(rows, DOCS).repartition(3), 12)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_passages(rows, 12)


def test_long_repetitive_texts_go_by_window_hashes(spark):
    rows = [(1, "w " * 3000), (2, "w " * 2500 + "v"), (3, "u " + "w " * 60)]
    assert rows_of(substring.deduplicated(spark.createDataFrame(rows, DOCS)), "doc_id", "n_words", "n_removed", "kept_sha256") == brute_passages(rows, 50)


def test_cut_texts_keep_what_lies_between(spark, awkward):
    shared = " ".join(f"s{k}" for k in range(60))
    rows = [(1, f"a\n b {shared} c"), (2, f"d  e\n{shared}\nf   g"), (3, shared), (4, "h  i")]
    got = dict(map(tuple, substring.without_passages(spark.createDataFrame(rows, DOCS)).collect()))
    assert got == {1: rows[0][1], 2: "d  e f   g", 4: "h  i"}
    left = substring.without_passages(awkward)
    assert left.columns == awkward.columns and left.count() == awkward.count()
    assert substring.deduplicated(awkward.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_automaton_finds_all_runs(seed):
    r = random.Random(seed)
    added = [[r.randint(0, 2) for _ in range(r.randint(0, 30))] for _ in range(5)]
    automaton = substring.SuffixAutomaton()
    for s in added:
        automaton.add(s)
    asked = [r.randint(0, 2) for _ in range(60)]
    runs = {tuple(s[k : k + 4]) for s in added for k in range(len(s) - 3)}
    assert automaton.matches(asked, 4) == [k for k in range(len(asked) - 3) if tuple(asked[k : k + 4]) in runs]


# Decontamination


def test_contamination_against_brute_force(spark):
    r = random.Random(5)
    items = [(k, " ".join(r.choice("abcde") * r.randint(1, 2) for _ in range(n))) for k, n in enumerate([0, 3, 4, 9, 12])] + [(9, None), (10, "É a! b")]
    docs = [(i, " ".join(r.choice(["a", "B", "c.", "dd", "e", "É", "é"]) for _ in range(r.randint(0, 60))) + f" {(items[r.randint(2, 4)][1] or '').upper()}") for i in range(40)]
    docs += [(99, None), (98, ""), docs[0]]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    expected = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for k, text in items:
            v = words(text)
            for q in {tuple(v[s : s + 4]) for s in range(max(1, len(v) - 3))} if v else ():
                for s in range(len(w) - len(q) + 1):
                    if tuple(w[s : s + len(q)]) == q:
                        hit |= set(range(s, s + len(q)))
                        found.add(str(k))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        expected.append((i, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    got = contamination(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, "item_id long, text string"), 4)
    assert rows_of(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(expected, key=str)


def test_contamination_of_awkward_rows(spark, awkward):
    items = spark.createDataFrame([(1, "two words", 5)], "item_id int, text string, key int")
    assert contamination(awkward, items).where("contaminated").select("doc_id", "n_hit").collect() == [(5, 2)]
    left = uncontaminated(awkward, items)
    assert left.columns == awkward.columns and left.count() == awkward.count() - 1
    assert contamination(awkward, items.limit(0)).where("n_hit > 0").count() == 0
    assert contamination(awkward.limit(0), items).count() == 0


def test_proximity(spark):
    items = spark.createDataFrame([(1, "a b c d")], "item_id int, text string")
    docs = spark.createDataFrame([(1, "d x c b a"), (2, "d x y z x y c b a"), (3, "a b c d")], DOCS)
    assert rows_of(contamination(docs, items, 5), "doc_id", "n_hit", "near_items") == [(1, 0, 1), (2, 0, 0), (3, 4, 1)]


# Token counts


def unigram(vocabulary):
    pieces = [*vocabulary.pieces, *((f"<0x{b:02X}>", -1000.0) for b in range(256 * vocabulary.bytes))]
    made = Tokenizer(models.Unigram(pieces, unk_id=len(vocabulary.pieces) - 1, byte_fallback=vocabulary.bytes))
    made.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=False)
    return made


@pytest.mark.parametrize("bytes_", [False, True])
@pytest.mark.parametrize("seed", range(60))
def test_counts_and_ties_are_the_tokenizers(seed, bytes_):
    """Whole texts: pieces of several spaces, spaces in a row, unknown signs as one token or as their bytes."""
    r = random.Random(seed)
    inner = seed % 2 * ["a▁b", "b▁"]
    pieces = sorted({"".join(r.choice("ab") for _ in range(r.randint(1, 4))) for _ in range(r.randint(1, 12))} | {"▁", "▁▁", "▁a", "▁▁b", *inner})
    # The cost of unknown signs follows from the worst piece, so the bytes' pieces must not be worse.
    vocabulary = Vocabulary((*((p, -float(r.randint(1, 4))) for p in pieces), ("<?>", -1.0 if not bytes_ else -1000.0)), "<?>", bytes_)
    counts, tokenizer = Counts(vocabulary), unigram(vocabulary)
    assert counts.by_words == (not inner)
    for _ in range(60):
        text = "".join(r.choice("aabbcé日   ▁") for _ in range(r.randint(0, 14)))
        assert counts.tokens(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), text


def test_bytes_and_runs_of_spaces_of_the_public_vocabulary():
    counts = counts_of(PIECES)
    assert counts.tokens("𒀀" * 100) == 1 + 400 and counts.tokens("\n") == 2
    assert counts.tokens("a" + " " * 9 + "b") < counts.tokens("a b") + 8


def test_counts_of_documents(spark, awkward):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))
    own = counts_of(PIECES)
    texts = [t or "" for _, t in docs.collect()]
    assert sorted(r["n_tokens"] for r in count_tokens(docs, PIECES).collect()) == sorted(map(own.tokens, texts))
    assert count_tokens(awkward.limit(0), PIECES).count() == 0


# Language-model scores


def test_gradient_and_probabilities():
    shape = pseudolikelihood.Shape(common=8, shared=8, slots=4, sides=2, width=5)
    network = pseudolikelihood.Network(shape)
    network.parts = {k: v.astype(np.float64) for k, v in network.parts.items()}
    r = np.random.default_rng(1)
    around, target = r.integers(0, 17, (30, 4)), r.integers(0, 16, 30)
    assert abs(sum(np.exp(network.log_probability(around[:1], np.array([k]))[0]) for k in range(16)) - 1) < 1e-9
    gradient = network.gradient(around, target)
    for name, part in network.parts.items():
        at = tuple(r.integers(0, n) for n in part.shape)
        old, losses = part[at], []
        for step in (1e-5, -1e-5):
            part[at] = old + step
            losses.append(-network.log_probability(around, target).mean())
        part[at] = old
        assert abs((losses[0] - losses[1]) / 2e-5 - gradient[name][at]) < 1e-6


def test_texts_in_order_score_better_than_shuffled(spark, awkward):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").repartition(4)
    model = pseudolikelihood.learn(docs)
    real = {r["doc_id"]: r for r in pseudolikelihood.score(docs, model).collect()}
    assert len(real) == docs.count()
    assert np.mean([r["per_token"] for r in real.values()]) > -7.2  # 7.6 if it had learnt nothing
    r, mixed = random.Random(0), []
    for i, t in docs.collect():
        words = t.split()
        r.shuffle(words)
        mixed.append((i, " ".join(words)))
    worse = pseudolikelihood.score(spark.createDataFrame(mixed, DOCS), model).collect()
    assert np.mean([real[x["doc_id"]]["log_probability"] >= x["log_probability"] for x in worse]) > 0.7
    odd = {(x["doc_id"], x["n_tokens"]): x for x in pseudolikelihood.score(awkward, model).collect()}
    assert odd[1, 0]["log_probability"] == 0 and odd[2, 0]["per_token"] is None and odd[7, 20_000]["log_probability"] < 0
    assert pseudolikelihood.score(awkward, pseudolikelihood.learn(awkward.limit(0))).count() == awkward.count()


def test_words_of_a_bucket_share_its_probability(spark):
    rows = [(k, f"a b{k % 3} c{k % 7} a") for k in range(40)]
    model = pseudolikelihood.learn(spark.createDataFrame(rows, DOCS), pseudolikelihood.Shape(common=2, shared=2, slots=2))
    counts = collections.Counter(w for _, t in rows for w in t.split())
    asked = [*counts, "unseen", "other"]
    scored = pseudolikelihood.score(spark.createDataFrame(list(enumerate(asked)) + [(0, asked[0])], DOCS), model).collect()
    assert len(scored) == len(asked) + 1
    got = {asked[r["doc_id"]]: np.exp(r["word_log_probability"]) for r in scored}
    ids = dict(zip(asked, model.ids(np.concatenate([pseudolikelihood.word_hashes(w.encode()) for w in asked])).tolist(), strict=True))
    # All words seen and one not seen of each bucket make up a distribution.
    left = {ids[w]: got[w] for w in ("unseen", "other")}
    for bucket in {2, 3} - set(left):
        left[bucket] = np.exp(model.network.log_probability(np.full((1, 6), 4), np.array([bucket]))[0]) * 0.5 / np.exp(model.buckets[bucket - 2])
    assert abs(sum(got[w] for w in counts) + sum(left.values()) - 1) < 1e-5
    for v in counts:
        for w in counts:
            if ids[v] == ids[w] >= 2:
                assert abs(got[v] / got[w] - (counts[v] + 0.5) / (counts[w] + 0.5)) < 1e-5


def test_every_place_is_trained_on(spark):
    shape = pseudolikelihood.Shape(common=4, shared=4, slots=4, width=3)
    for text in ("one", "two", "three", "four", "five"):
        made = pseudolikelihood.learn(spark.createDataFrame([(1, text)], DOCS), shape).network
        assert (made.flat() != pseudolikelihood.Network(shape).flat()).any()
    # Each place of a text of six words is a target in exactly one round.
    docs = spark.createDataFrame([(1, "a b c d e f")], DOCS)
    model = pseudolikelihood.learn(docs, pseudolikelihood.Shape(common=8, shared=4, slots=1, rounds=0))
    targets = collections.Counter()
    for number in range(2):
        network = pseudolikelihood.Network(pseudolikelihood.Shape(common=8, shared=4, slots=1, rounds=2))
        start = pseudolikelihood.Model(model.hashes, model.outputs, network)
        moved = pseudolikelihood.train_round(docs, start, number).parts["class_bias"]
        targets.update(np.flatnonzero(moved > 0).tolist())
    assert targets == dict.fromkeys(range(6), 1)


def test_frequent_words_are_looked_up_and_only_rare_ones_joined(spark, awkward, monkeypatch):
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(k, f"a b{k % 3} c{k % 7} d{k} a") for k in range(20, 60)], DOCS))
    others = docs.unionByName(spark.createDataFrame([(99, "unseen a b1 unseen"), (99, "unseen a b1 unseen")], DOCS))
    shape = pseudolikelihood.Shape(common=2, shared=4, slots=2)
    staged, keep = [], pseudolikelihood.stage
    monkeypatch.setattr(pseudolikelihood, "stage", lambda df: staged.append(keep(df)) or staged[-1])
    scored, joined = [], []
    for most in (1 << 20, 16, 1):
        monkeypatch.setattr(pseudolikelihood, "FREQUENT", most)
        model = pseudolikelihood.learn(docs, shape)
        counts = collections.Counter(dict(map(tuple, model.words.collect())))
        assert len(model.frequent[0]) == sum(n * most >= counts.total() for n in counts.values()) <= most
        scored.append(sorted(pseudolikelihood.score(others, model).collect(), key=str))
        joined.append(staged[-1].select(F.sum(F.size("words"))).first()[0])
    assert joined[0] in (2, 4) and 100 < joined[1] == joined[2]  # at first the unseen word alone, of one copy or both
    for rows in scored[1:]:
        for got, plain in zip(rows, scored[0], strict=True):
            assert got[:4] == plain[:4] and got[4] == pytest.approx(plain[4], rel=1e-9)
    for r in scored[0]:
        assert (r["per_word"] is None) == (r["n_tokens"] == 0)


def test_words_of_many_texts_are_hashed_as_those_of_each(awkward, spark):
    from quillforge.llm import wordhash

    texts = [(t or "").encode() for _, t in awkward.select("doc_id", "text").collect()]
    texts += [b"a", b"", b" a", b"a ", b"x" * wordhash.TOGETHER, b"y" * (wordhash.TOGETHER + 1), b"z\n" * wordhash.TOGETHER, b"\xff\xfe b"] + [b"k %d" % k for k in range(40_000)]
    hashes, n = wordhash.texts_word_hashes(texts)
    own = [wordhash.word_hashes(t) for t in texts]
    assert n.tolist() == [len(x) for x in own] and (hashes == np.concatenate(own)).all()
    assert [len(x) for x in wordhash.texts_word_hashes([])] == [0, 0]


@pytest.mark.parametrize("size", [1, 200])  # the larger logits overflow unless the greatest is taken off
def test_places_of_a_line_against_plain_formulas(size):
    shape = pseudolikelihood.Shape(common=8, shared=8, slots=4, sides=2, width=5)
    network, r = pseudolikelihood.Network(shape), np.random.default_rng(2)
    network.parts = {k: v * (size if "_" in k else 1) + r.normal(0, size, v.shape).astype(np.float32) for k, v in network.parts.items()}
    line = np.concatenate([[16, 16], r.integers(0, 16, 60), [16, 16]])
    places, p = np.arange(2, 62)[r.random(60) < 0.6], {k: v.astype(np.float64) for k, v in network.parts.items()}
    expected, around = [], np.stack([line[places + k] for k in shape.offsets], 1)
    for words, target in zip(around, line[places], strict=True):
        h = np.tanh(p["bias"] + sum(p["embed"][w] * place for w, place in zip(words, p["place"], strict=True)))
        c = target // 4
        own = slice(4 * c, 4 * c + 4)
        parts = (p["to_class"] @ h + p["class_bias"], c), (p["to_slot"][own] @ h + p["slot_bias"][own], target % 4)
        expected.append(sum(x[k] - x.max() - np.log(np.exp(x - x.max()).sum()) for x, k in parts))
    assert network.log_probability_along(line, places) == pytest.approx(np.array(expected), rel=2e-4, abs=2e-4)
    plain = network.gradient(around, line[places])
    for name, g in network.gradient_along(line, places).items():
        assert np.isfinite(g).all() and g.shape == plain[name].shape and g.dtype == np.float32
        assert np.abs(g - plain[name]).max() < 1e-5 * max(1, np.abs(plain[name]).max())


def test_batches_of_places_reach_over_texts(spark):
    texts = ["a b c d e f g", "", "h", "a c e g i k m o q s u w y " * 5, None, "b a", "c b a d"]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).coalesce(1)
    start = pseudolikelihood.learn(docs, pseudolikelihood.Shape(common=8, shared=8, slots=4, width=3, rounds=0))
    shape = pseudolikelihood.Shape(common=8, shared=8, slots=4, width=3, rounds=2, batch=5)
    start = pseudolikelihood.Model(start.hashes, start.outputs, pseudolikelihood.Network(shape))
    salts = [r[0] for r in docs.select(F.pmod(F.xxhash64("text"), F.lit(2))).collect()]
    for number in range(2):
        rows = []
        for salt, text in zip(salts, texts, strict=True):
            ids = [16] * 3 + start.ids(pseudolikelihood.word_hashes((text or "").encode())).tolist() + [16] * 3
            rows += [[ids[k + o] for o in (*shape.offsets, 0)] for k in range(3, len(ids) - 3) if (k - 3 + salt + number) % 2 == 0]
        network = pseudolikelihood.Network(shape)
        squares = {k: np.full_like(v, 1e-6) for k, v in network.parts.items()}
        for k in range(0, len(rows), 5):
            own = np.array(rows[k : k + 5])
            for name, g in network.gradient(own[:, :-1], own[:, -1]).items():
                squares[name] += g * g
                network.parts[name] -= shape.rate * g / np.sqrt(squares[name])
        assert pseudolikelihood.train_round(docs, start, number).flat() == pytest.approx(network.flat(), abs=1e-4)
