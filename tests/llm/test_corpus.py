"""Operators that compare texts, pack or learn."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seqprep.llm import chat, components, decontaminate, near_dedup, packing, quality, suffix_array, suffix_dedup
from tests.llm.cases import as_rows, clashing, documents, prose, rows

# --- packing ------------------------------------------------------------------


def check_packing(made, texts, capacity):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoded = [np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for _, t in texts]
    want = collections.Counter()
    for (doc_id, _), ids in zip(texts, encoded):
        pieces = -(-len(ids) // capacity)
        cuts = [max(0, len(ids) - capacity * (pieces - k)) for k in range(pieces)] + [len(ids)]
        for k in range(pieces):
            own = ids[cuts[k] : cuts[k + 1]]
            want[doc_id, k, cuts[k], len(own), zlib.crc32(own.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in made) == want
    by = collections.defaultdict(list)
    for r in made:
        by[r.sequence_id].append((r.offset, r.length))
    for placed in by.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), sum(len(ids) for ids in encoded)


def test_packing(spark):
    made = packing.pack(documents(spark), capacity=256).collect()
    sequences, tokens = check_packing(made, rows(), 256)
    assert sequences <= 1.1 * tokens / 256 + 2


def test_packing_of_nothing_and_of_clashing_columns(spark):
    assert packing.pack(documents(spark, [])).count() == 0
    assert packing.pack(clashing(documents(spark))).count() == packing.pack(documents(spark)).count()


def test_sequences_hold_the_ids(spark):
    packed = packing.pack(documents(spark, [(1, prose(1, 30)), (2, prose(2, 20)), (3, "")]), capacity=64, keep_ids=True)
    made = packing.sequences(packed).collect()
    assert all(len(r.ids) <= 64 for r in made) and sum(r.ids.count(0) for r in made) == 3
    assert sum(len(r.ids) for r in made) == packed.agg(F.sum("length")).first()[0]


def test_plan_uses_patterns_and_wastes_little():
    rng = np.random.default_rng(2)
    histogram = np.bincount(np.clip(rng.gamma(2, 150, 60_000).astype(int) + 1, 1, 512), minlength=513)
    made = packing.plan(histogram, 512)
    used = np.zeros(513, np.int64)
    for lengths, n in made:
        assert sum(lengths) <= 512
        for v in lengths:
            used[v] += n
    assert (used == histogram).all()
    total = int((histogram * np.arange(513)).sum())
    longest = int(histogram[257:].sum())
    assert sum(n for _, n in made) <= 1.02 * max(-(-total // 512), longest)


def test_encoder_equals_the_library():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.Encoder("byte_bpe_50k.json")
    rng = random.Random(4)
    parts = [*" \n.,ab'%1ß", "'ll", " the", " thn.", "中", " b", "\t", "\x85", "\u3000", "<|endoftext|>", "  "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    texts += [f"a{chr(k)} {chr(k)}b1{chr(k)}" for k in range(1, 0x30000) if not 0xD800 <= k < 0xE000]
    texts += ["x" * 20_000, " " * 3000 + "y", "ab" * 5000]
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [encoder.encode(t) for t in texts] == want


def test_encoder_takes_very_long_white_space(monkeypatch):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def check(encoder, texts):
        for text in texts:
            assert encoder.encode(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    runs = [" " * 1_100_000, "\n" * 1_100_000, "\t" * 1_100_000, " \n" * 600_000]
    check(packing.Encoder("byte_bpe_50k.json"), ["a" + run + end for run in runs for end in ("", "b c")])
    # Every kind of neighbour, with the cut at short runs.
    monkeypatch.setattr(packing, "LONG_RUN", 3)
    rng = random.Random(6)
    parts = [*" \n\t.a1'", "'ll", " the", "    ", "\n\n\n", "  \n", "\x1c", "\x85", "\u3000", "<|endoftext|>", "<|end", "\u0301"]
    check(packing.Encoder("byte_bpe_50k.json"), ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)])


# --- near-duplicates ------------------------------------------------------------


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    return frozenset(zip(*(words[k:] for k in range(width)))) if len(words) >= width else frozenset([tuple(words)] if words else [])


def plain_components(texts, width):
    sets = [shingle_set(t, width) for _, t in texts]
    label = list(range(len(texts)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and texts[i][0] is not None and texts[j][0] is not None and 100 * len(a & b) >= 80 * len(a | b):
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(texts):
        least[root(i)].append(doc_id)
    return sorted(
        ((d, len(sets[i]), None if d is None else min(least[root(i)]), d is None or d == min(least[root(i)])) for i, (d, _) in enumerate(texts)), key=repr
    )


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, width):
    assert as_rows(near_dedup.near_duplicates(documents(spark), width)) == plain_components(rows(), width)


def near_copies():
    rng = random.Random(8)
    made = []
    for group in range(3):
        words = prose(50 + group, 150).split()
        for _ in range(25):
            own = list(words)
            for _ in range(rng.randint(0, 14)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
            made.append((len(made), " ".join(own)))
    return made


@pytest.mark.parametrize("rows, size, elements", [(512, 8 << 20, 4096), (7, 8 << 20, 50), (512, 5000, 3)])
def test_crowded_buckets_lose_no_link(spark, monkeypatch, rows, size, elements):
    for name, value in (("CROWD_ROWS", rows), ("CROWD_BYTES", size), ("ELEMENTS", elements)):
        monkeypatch.setattr(near_dedup, name, value)
    made = near_copies()
    assert as_rows(near_dedup.near_duplicates(documents(spark, made), small=3)) == plain_components(made, 2)


def test_texts_below_the_threshold_give_no_pair_rows(spark, monkeypatch):
    """Copies of one text, each with eight words of its own: no two are similar, though all share bands."""
    rng, words = random.Random(3), prose(70, 120).split()
    made = []
    for k in range(120):
        own = list(words)
        for place in rng.sample(range(len(own)), 8):
            own[place] = f"w{rng.randrange(10**9)}"
        made.append((k, " ".join(own)))
    tried = []
    confirmed = near_dedup.confirmed
    monkeypatch.setattr(near_dedup, "confirmed", lambda pairs, *a: tried.append(pairs.count()) or confirmed(pairs, *a))
    assert as_rows(near_dedup.near_duplicates(documents(spark, made))) == plain_components(made, 2)
    assert sum(tried) <= 120 * near_dedup.PIVOT_BANDS * 3


def linked_graphs():
    rng = random.Random(4)
    order = rng.sample(range(400), 400)
    yield [(5, 5)]  # no link at all
    yield [(k, k + 1) for k in range(300)]
    yield [(order[k], order[k + 1]) for k in range(399)] + [(7, 7), (order[1], order[0])]
    yield [(999, k) for k in range(300)] + [(k, 1000) for k in range(250, 350)]
    yield [(rng.randrange(500), rng.randrange(500)) for _ in range(350)]
    # nodes of a crowd, each in several large buckets, linked with the least node of each
    buckets = [rng.sample(range(600), 120) for _ in range(30)]
    yield [(node, min(bucket)) for bucket in buckets for node in bucket]


@pytest.mark.parametrize("links", list(linked_graphs()))
def test_components_read_the_links_about_once(spark, monkeypatch, links):
    label = {node: node for link in links for node in link if link[0] != link[1]}
    for _ in label:
        for a, b in links:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    frame = spark.createDataFrame(links, "a long, b long")
    read, join = [], type(frame).join

    def counted(left, right, *how):
        read.append(left.count() if {"a", "b"} <= set(left.columns) else 0)
        return join(left, right, *how)

    monkeypatch.setattr(type(frame), "join", counted)
    got = components.components(frame).collect()
    assert {r.node: r.label for r in got} == label and len(got) == len(label)
    assert sum(read) <= 5 * len({frozenset(link) for link in links if link[0] != link[1]})


def test_intersections_and_forest():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype(np.uint64)) for _ in range(30)]
    got = near_dedup.intersections(sets[:10], sets[10:])
    assert (got == [[len(np.intersect1d(a, b)) for b in sets[10:]] for a in sets[:10]]).all()
    a, b = near_dedup.forest(np.arange(5), np.arange(5, 9), np.array([0, 0, 1, 1, 4]), np.array([0, 1, 0, 1, 3]))
    assert list(zip(a, b)) == [(0, 5), (0, 6), (1, 5), (4, 8)]


def test_near_duplicates_of_nothing_and_of_clashing_columns(spark):
    assert near_dedup.near_duplicates(documents(spark, [])).count() == 0
    docs = documents(spark)
    assert as_rows(near_dedup.near_duplicates(clashing(docs))) == as_rows(near_dedup.near_duplicates(docs))
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns and {0, 4, 6, 7, 16} <= {r.doc_id for r in kept.collect()}
    assert not {1, 14} & {r.doc_id for r in kept.collect()}


def test_odd_sketches_estimate():
    sampler = near_dedup.Sampler()
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    a, b = np.unique(values[:900]), np.unique(values[100:])  # similarity 0.8
    x, y = sampler.sketch(sampler.samples(a)), sampler.sketch(sampler.samples(b))
    bits = sum(bin(int(p) & (2**64 - 1)).count("1") for p in x ^ y)
    estimate = 1 + near_dedup.SKETCH_BITS / (4 * near_dedup.SAMPLES) * np.log(1 - 2 * bits / near_dedup.SKETCH_BITS)
    assert abs(estimate - 0.8) < 0.12 and bits <= near_dedup.most_differing_bits()


# --- repeated byte strings --------------------------------------------------------


def plain_removal(texts):
    seen, out = set(), []
    for doc_id, text in texts:
        raw = (text or "").encode()
        mark = np.zeros(len(raw), bool)
        if doc_id is not None:
            for p in range(len(raw) - 99):
                window = raw[p : p + 100]
                if window in seen:
                    mark[p : p + 100] = True
                seen.add(window)
        starts = int((mark & ~np.concatenate([[False], mark[:-1]])).sum()) if len(raw) else 0
        kept = np.frombuffer(raw, np.uint8)[~mark].tobytes()
        out.append((doc_id, len(raw), int(mark.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("crowd", [2, 2000])
def test_repeats(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "SHARD", 3000)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 4096)
    line = "This very common line stands in many documents, between others. "
    texts = [r for r in rows() if r[0] != 16] + [(20 + k, prose(60 + k, 25) + line + prose(80 + k, 25) + line * (k % 3)) for k in range(12)]
    assert as_rows(suffix_dedup.remove_repeats(documents(spark, texts))) == plain_removal(texts)


def test_repeats_of_rows_that_share_an_id(spark):
    made = suffix_dedup.remove_repeats(documents(spark, [(1, prose(1)), (1, prose(1)), (1, prose(2))])).collect()
    assert [r.n_removed for r in made] == [0, 0, 0]
    assert suffix_dedup.remove_repeats(documents(spark, [])).count() == 0
    docs = documents(spark)
    assert as_rows(suffix_dedup.remove_repeats(clashing(docs))) == as_rows(suffix_dedup.remove_repeats(docs))


def test_suffix_array():
    rng = np.random.default_rng(0)
    for _ in range(60):
        text = rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(1, 400))).astype(np.uint8)
        raw = text.tobytes()
        order, rank = suffix_array.suffix_array(text, 100)
        assert [raw[i : i + 100] for i in order] == sorted(raw[i : i + 100] for i in range(len(raw)))
        found = suffix_array.common_prefixes(text, order, rank, 100, lanes=int(rng.integers(1, 9)))
        for k in range(1, len(raw)):
            x, y = raw[order[k - 1] :][:100], raw[order[k] :][:100]
            assert found[k] == next((n for n, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))


# --- benchmark --------------------------------------------------------------------


def plain_leaks(texts, items, width=5):
    import regex

    words = lambda t: regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
    grams = lambda w, k: collections.Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = {}
    for doc_id, text in texts:
        own = words(text)
        for item_id, item in items:
            target = words(item)
            k = min(width, len(target))
            size = min(len(target), len(own))
            if not target or size < k:
                continue
            want = grams(target, k)
            for s in range(len(own) - size + 1):
                window = grams(own[s : s + size], k)
                both = sum((window & want).values())
                score = both / (sum(window.values()) + sum(want.values()) - both)
                if 100 * both >= 80 * (sum(window.values()) + sum(want.values()) - both) and score > out.get((doc_id, item_id), (0,))[0]:
                    out[doc_id, item_id] = (score, s)
    return {k: (round(v[0], 9), v[1]) for k, v in out.items()}


def test_leaks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SEGMENT", 50)
    monkeypatch.setattr(decontaminate, "MOST_SHINGLES", 70)
    a, b, c = prose(31, 40), prose(32, 60), "la la la la la la la la la la"
    words = a.split()
    changed = " ".join([*words[:38], "new", *words[39:]])
    items = [(1, a), (2, b), (3, c), (4, "two words"), (5, ""), (6, None), (7, a)]
    texts = [
        (1, prose(33) + " " + a + " " + prose(34)), (2, prose(35) + " " + changed.upper().replace(" ", ", ")), (3, " ".join(words[:-4])),
        (4, prose(36, 300) + b + " " + a), (5, "so la la la la la la la la la la la la"), (6, "Two words!"), (7, None), (8, ""), (9, prose(37)),
        (None, a), (1, a), (10, " ".join(words[:37]) + " extra " + " ".join(words[37:])),
    ]
    made = decontaminate.leaks(clashing(documents(spark, texts)), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9)) for r in made}
    want = {}
    for part in (texts[:10], texts[10:]):
        for key, (score, _) in plain_leaks(part, items).items():
            want[key] = max(score, want.get(key, 0))
    assert got == want and len(made) == len(got) and (10, 1) in got
    docs = documents(spark, texts)
    left = decontaminate.drop_leaking(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id for r in left.collect()} == {7, 8, 9} and left.columns == docs.columns


def test_leaks_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(documents(spark), none).count() == 0
    assert decontaminate.leaks(documents(spark, []), spark.createDataFrame([(1, "a b c d e f")], none.schema)).count() == 0


def test_decontamination_is_native(spark, capsys):
    items = spark.createDataFrame([(1, prose(31, 40))], "item_id long, text string")
    decontaminate.leaks(documents(spark), items).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


# --- quality: weights and calibration against plain versions ------------------------


def test_ridge_weights_equal_a_dense_solve(spark):
    rng = np.random.default_rng(4)
    n = 400
    table = rng.normal(size=(n, len(quality.FIGURES))).astype(np.float32)
    label = (table[:, 0] + 0.3 * rng.normal(size=n) > 0).astype(float)
    rows = [(k, *map(float, table[k]), float(label[k])) for k in range(n)]
    columns = ["doc_id long", *(f"{f} float" for f in quality.FIGURES), "label double"]
    examples = spark.createDataFrame(rows, ", ".join(columns)).repartition(7)
    kernel = quality.Kernel(table.mean(axis=0), table.std(axis=0), 50)
    total = quality.normal_equations(examples, kernel)
    z = kernel(table.astype(float))
    assert np.allclose(total[:-1, :-1], z.T @ z) and np.allclose(total[:-1, -1], z.T @ label)
    # Ridge as least squares with one more row per weight.
    strength = 0.7
    dense = np.linalg.lstsq(np.vstack([z, np.sqrt(strength) * np.eye(z.shape[1])]), np.append(label, np.zeros(z.shape[1])), rcond=None)[0]
    assert np.allclose(quality.ridge(total, strength), dense, atol=1e-8)
    raw = {r.doc_id: r.raw for r in quality.raw_scores(examples, kernel, dense).collect()}
    assert np.allclose([raw[k] for k in range(n)], np.clip(z @ dense, quality.LOW, quality.HIGH), atol=1e-8)


def test_calibration_equals_plain_pooling():
    rng = random.Random(6)
    for _ in range(30):
        counts, positives = np.zeros(quality.BINS), np.zeros(quality.BINS)
        for i in rng.sample(range(quality.BINS), 12):
            counts[i] = rng.randint(1, 9)
            positives[i] = rng.randint(0, int(counts[i]))
        centres, shares = quality.isotonic(counts, positives)
        # The fit of a bin is the largest of the smallest means over the runs around it.
        used = np.flatnonzero(counts).tolist()
        mean = lambda a, b: positives[used[a] : used[b] + 1].sum() / counts[used[a] : used[b] + 1].sum()
        plain = [max(min(mean(a, b) for b in range(k, len(used))) for a in range(k + 1)) for k in range(len(used))]
        assert np.allclose(sorted(set(np.round(plain, 9))), np.unique(np.round(shares, 9)))
        assert (np.diff(shares) >= 0).all() and (np.diff(centres) > 0).all()


# --- conversations ------------------------------------------------------------------

TREE = "tree long, id long, parent long, role string, text string, score double"


def test_best_path_of_a_tree(spark):
    made = [
        (1, 0, None, "user", "root", 0.0), (1, 1, 0, "assistant", "a", 1.0), (1, 2, 0, "assistant", "b", 5.0), (1, 3, 1, "user", "a1", 9.0),
        (1, 4, 2, "user", "b1", 2.0), (1, 5, 2, "user", "b2", 2.0), (2, 7, 99, "user", "orphan", None), (None, 1, None, None, None, 1.0),
    ]
    two = chat.format_trees(spark.createDataFrame(made, TREE), best=2)
    got = {(r.tree, r["rank"]): r.formatted for r in two.collect()}
    join = lambda *turns: "".join(f"[INST]{r}[/INST]{t}</s>" for r, t in turns)
    assert got == {
        (1, 1): join(("user", "root"), ("assistant", "a"), ("user", "a1")),
        (1, 2): join(("user", "root"), ("assistant", "b"), ("user", "b1")),
        (2, 1): join(("user", "orphan")),
        (None, 1): join(("", "")),
    }


def test_cycle_is_an_error(spark):
    made = [(1, 1, 2, "user", "x", 1.0), (1, 2, 1, "user", "y", 1.0), (1, 3, None, "user", "z", 1.0)]
    with pytest.raises(ValueError, match="cycle"):
        chat.format_trees(spark.createDataFrame(made, TREE))


def test_control_strings_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "\\", "[\\INST]", "\\\\[/INST]\\", "<<SYS>>x<</SYS>>", "<s", "", None, "é</s>中"]
    turns = [(k % 3, k // 3, ("user", "assistant")[k // 3 % 2], t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    formatted = chat.format_trees(chat.messages_of(df))
    got = {r.conv_id: r for r in chat.digest(formatted).collect()}
    for conv in range(3):
        own = sorted(t for t in turns if t[0] == conv)
        told = "".join(f"{r}\n{t or ''}\n" for _, _, r, t in own)
        loss = "".join(t or "" for _, _, r, t in own if r == "assistant")
        assert got[conv].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_trees(chat.messages_of(df.limit(0))).count() == 0


# --- quality --------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    from tests.conftest import SF_SMALL

    base = SF_SMALL.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    made = quality.quality_scores(clashing(docs), labels)
    assert made.count() == docs.count() and made.filter("score < 0 or score > 1 or score is null").isEmpty()
    joined = made.filter("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("a")).first()
    assert joined.a > 0.95
    wrong = made.filter(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 5 == 0))
    assert wrong.isEmpty()


def test_quality_without_labels(spark):
    labels = spark.createDataFrame([(3, None), (None, 1)], "doc_id long, quality int")
    made = quality.quality_scores(documents(spark), labels)
    assert made.count() == len(rows()) and {r.score for r in made.collect()} == {0.5}
    assert quality.quality_scores(documents(spark, []), labels).count() == 0


def test_isotonic_is_monotone():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 5, 300).astype(float)
    centres, shares = quality.isotonic(counts, np.minimum(counts, rng.integers(0, 5, 300)))
    assert (np.diff(centres) > 0).all() and (np.diff(shares) > 0).all()
