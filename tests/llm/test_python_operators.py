"""Operators with numpy kernels, against brute force on small fixtures."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import bucket, lower, sample, words
from pyspark.sql import functions as F

from tamiz.llm import compression, fingerprints, jaccard_join, language_model, lines, packing, substrings
from tamiz.llm.common import bucket_of, connected_components

EDGES = ["no_docs", "null_docs"]


def gram_set(text):
    own = words(lower(text))
    return frozenset(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))) if own else frozenset()


def reached(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(4)
    chain = [(k, k + 1) for k in range(100, 140)]
    links = [(rng.randrange(30), 30 + rng.randrange(30)) for _ in range(40)] + chain + [(200, 200)]
    made = connected_components(spark.createDataFrame(links, "a long, b long"), "test").collect()
    links.remove((200, 200))
    want = reached({n for ab in links for n in ab}, links)
    assert {r.node: r.component for r in made} == want and len(made) == len(want)


# Similarity join


def test_similarity_groups(odd_docs, odd_rows):
    near = [r for r in odd_rows]
    sets = [(d, gram_set(t)) for d, t, _ in near]
    links = [
        (a, b)
        for (a, x), (b, y) in itertools.combinations(sets, 2)
        if x and y and 100 * len(x & y) >= 80 * len(x | y)
    ]
    want = reached({d for d, _ in sets}, links)
    rows = jaccard_join.similarity_groups(odd_docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == Counter((d, len(s), want[d]) for d, s in sets)
    assert len(set(want.values())) < len(want) - 5
    kept = jaccard_join.one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} == set(want.values())


def test_long_index_lists_skip_blocks_without_losing_pairs():
    rng = np.random.default_rng(3)
    for length in (5, 300, 700):
        n = np.sort(rng.integers(5, 60, length))
        rest = n - rng.integers(0, 12, length).clip(max=n - 1)
        found = {(int(a), int(b)) for i, j in jaccard_join.list_pairs(np.array([0]), n, rest) for a, b in zip(i, j)}
        need = lambda a, b: -(-80 * (n[a] + n[b]) // 180)
        want = {(a, b) for a, b in itertools.combinations(range(length), 2) if min(rest[a], rest[b]) >= need(a, b)}
        assert found == want


def test_sketches_bound_the_common_size():
    rng = np.random.default_rng(6)
    sets = []
    for n in (1, 2, 5, 30, 31, 33, 120, 127, 129, 500, 640):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for share in (1.0, 0.95, 0.9, 0.8, 0.5, 0.0):
            other = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            sets.append(np.unique(np.where(rng.random(n) < share, base, other)))
    begins = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    raw = jaccard_join.sketches(np.concatenate(sets), begins).to_pylist()
    known = jaccard_join.Sketches(raw, np.diff(begins))
    i, j = (np.array(x) for x in zip(*itertools.combinations(range(len(sets)), 2)))
    fit, far = known.may_link(i, j), 0
    for a, b, open_ in zip(i, j, fit):
        common = len(np.intersect1d(sets[a], sets[b]))
        linked = 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common)
        assert open_ or not linked
        far += open_ and common < 0.6 * len(sets[a])
    assert far < 0.05 * len(i)


@pytest.mark.parametrize("block,cell", [(128, 256), (8, 4)])
def test_long_lists_of_many_families(spark, monkeypatch, block, cell):
    """Families of near copies that share frequent passages, so that index lists are long and mixed."""
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", block)
    monkeypatch.setattr(jaccard_join, "CELL_SETS", cell)
    rng = random.Random(5)
    passage = [f"p{k}" for k in range(12)]
    rows = []
    for family in range(7):
        base = [f"f{family}w{k}" for k in range(60)] if family % 2 else [f"g{k}" for k in range(10 * family, 10 * family + 60)]
        for k in range(22):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(60)] = f"x{rng.randrange(9)}"
            at = rng.randrange(60)
            rows.append((1000 * family + k, " ".join(own[:at] + passage[: rng.randrange(12)] + own[at:])))
    sets = {d: gram_set(t) for d, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in jaccard_join.similarity_groups(docs).collect()}
    assert found == reached(sets, links) and 7 < len(set(found.values())) < 150


def test_clashing_columns_are_carried_along(spark):
    """Columns named like the ones used inside come back as they were."""
    names = ["_doc", "_part", "_kept", "_row", "_id", "_whole", "_covered", "key", "sketch", "node"]
    shared = " ".join(f"word{k}" for k in range(30))
    rows = [(k, shared if k < 3 else f"{shared} tail {k}\nown {k}" if k < 6 else f"text {k}", *(f"{c}{k}" for c in names)) for k in range(8)]
    rows.append((None, "no id", *(f"{c}x" for c in names)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names))
    for made in (jaccard_join.one_per_group(docs), lines.dedup_lines(docs, 10)):
        assert made.columns == docs.columns
        found = made.collect()
        assert found and all(r[c] == f"{c}{'x' if r.doc_id is None else r.doc_id}" for r in found for c in names)


def test_chains_of_links_are_followed(spark):
    """Each text is near the next one but far from those beyond."""
    body = [f"t{k}" for k in range(400)]
    rows = [(k, " ".join(body[k * 8 : k * 8 + 100])) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.similarity_groups(docs).collect()
    assert {r.component_id for r in found} == {0}


# Substrings


def brute_substrings(rows):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        raw = text.encode()
        covered = np.zeros(len(raw), bool)
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                covered[i : i + 100] = True
            seen.add(raw[i : i + 100])
        runs = int(covered[:1].sum() + (covered[1:] & ~covered[:-1]).sum())
        out[doc] = (len(raw), int(covered.sum()), runs, hashlib.sha256(np.frombuffer(raw, np.uint8)[~covered].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("many", [substrings.MANY, 1])
def test_substrings(spark, monkeypatch, many):
    monkeypatch.setattr(substrings, "MANY", many)
    rows = sample() + [(100, ""), (101, "z" * 99), (102, "z" * 100), (103, "z" * 700), (104, "ab" * 300), (105, "abc " * 90)]
    rows += [(106, rows[1][1][:150] + "☃" + rows[1][1][40:260]), (107, "q" * 60 + rows[2][1][:99])]
    nulls = [(None, "fresh"), (108, None), (5, rows[5][1])]
    docs = spark.createDataFrame(rows + nulls, "doc_id long, text string").withColumn("size", F.lit("x")).repartition(4)
    want = brute_substrings(rows)
    found = substrings.remove_repeats(docs).collect()
    assert len(found) == len(rows) + 3
    for r in found:
        got = (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
        if r.doc_id is None:
            assert got[1:3] == (0, 0)
        elif r.doc_id == 108:
            assert got[:3] == (0, 0, 0)
        else:
            assert got == want[r.doc_id]
    assert sum(v[1] for v in want.values()) > 2000


def test_marks_fill_all_buckets_alike():
    data = np.random.default_rng(1).integers(0, 256, 300_000).astype(np.uint8)
    mark = np.sort(substrings.runs(data, np.array([0, len(data)]))[3])
    sizes = np.diff(substrings.split(mark, 64, 64))
    assert sizes.sum() == len(mark) > 5000 and sizes.max() < 2 * sizes.mean()


def test_repeated_rows_in_one_partition_keep_their_text(spark):
    rows = [(1, "q" * 60 + " one text of its own " * 9), (2, sample()[1][1]), (3, "ab" * 300), (4, sample()[1][1] + " more")]
    want = brute_substrings(rows)
    docs = spark.createDataFrame(rows * 3, "doc_id long, text string").coalesce(1)
    found = substrings.remove_repeats(docs).collect()
    assert len(found) == 3 * len(rows) and want[2][1] == 0 < want[4][1]
    for r in found:
        assert (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) == want[r.doc_id]


def key_order(spark, rows):
    """Rows as documents in the operator's order: id, null last, then the hash of the text; repeated rows once."""
    own = {t: h for t, h in spark.createDataFrame([(r[1],) for r in rows], "t string").select("t", F.xxhash64("t")).collect()}
    return sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, own[r[1]]))


@pytest.mark.parametrize("many", [substrings.MANY, 1])
def test_ids_of_several_texts_and_rows_without_id(spark, monkeypatch, many):
    monkeypatch.setattr(substrings, "MANY", many)
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz "
    part = ["".join(rng.choice(letters) for _ in range(300)) for _ in range(8)]
    rows = [(1, part[0]), (2, part[1] + part[0]), (2, part[2] + part[3]), (2, part[4] + part[1]), (2, part[4] + part[1])]
    rows += [(None, part[3]), (None, part[5] + part[4][:150]), (None, part[5]), (None, part[5]), (None, ""), (7, part[6] + part[6])]
    rows += [((1 << 63) - 1, part[6] + part[7]), (0, part[7] + "!")]
    ordered = key_order(spark, rows)
    want = dict(zip(ordered, (v for _, v in sorted(brute_substrings(list(enumerate(t for _, t in ordered))).items())), strict=True))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"doc": F.lit("x"), "base": F.lit("y"), "own": F.lit(1)})
    found = substrings.remove_repeats(docs.repartition(3)).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found]
    assert sorted(got, key=str) == sorted(((d, *want[d, t]) for d, t in rows), key=str)
    assert want[2, rows[2][1]][1] == 0 and want[7, rows[10][1]][1] == 300 and sum(v[1] for v in want.values()) > 1500


def test_collection_order():
    rng = random.Random(1)
    for _ in range(40):
        found = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 7))]
        owner, length, common = substrings.collection_order(found)
        got = [found[j][len(found[j]) - k :] for j, k in zip(owner, length)]
        assert got == sorted(s[len(s) - k :] for s in found for k in range(len(s) + 1))
        for a, b, shared in zip(got, got[1:], common[1:]):
            assert shared == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


# Lines


def brute_runs(texts, least):
    """Per text the lines in maximal equal runs of `least` words with a place that stands earlier."""
    own = [[(k, line) for k, line in enumerate(t.split("\n")) if words(line)] for t in texts]
    at = [(d, i) for d, held in enumerate(own) for i in range(len(held))]
    gone = [set() for _ in texts]
    for (s, j), (d, i) in itertools.combinations(at, 2):
        if i and j and own[s][j - 1][1] == own[d][i - 1][1]:
            continue
        n = 0
        while j + n < len(own[s]) and i + n < len(own[d]) and own[s][j + n][1] == own[d][i + n][1]:
            n += 1
        if sum(len(words(line)) for _, line in own[d][i : i + n]) >= least:
            gone[d].update(k for k, _ in own[d][i : i + n])
    return gone


def test_lines(odd_docs, odd_rows):
    rows = sorted(dict.fromkeys((d, t) for d, t, _ in odd_rows), key=lambda r: r[0])
    for least in (1, 10, 25):
        want = dict(zip([d for d, _ in rows], brute_runs([t or "" for _, t in rows], least), strict=True))
        made = lines.dedup_lines(odd_docs, least, detail=True).collect()
        assert len(made) == len(odd_rows)
        texts = dict(rows)
        for r in made:
            assert set(r.removed) == want[r.doc_id]
            left = [x for k, x in enumerate((texts[r.doc_id] or "").split("\n")) if k not in want[r.doc_id]]
            assert (r.text or "") == "\n".join(left)
    kept = lines.dedup_lines(odd_docs, 10)
    assert kept.columns == odd_docs.columns and dict(kept.dtypes) == dict(odd_docs.dtypes)
    for r in kept.collect():
        assert r.n_chars == (None if r.text is None else len(r.text))


def test_runs_reach_to_their_last_equal_line(spark):
    rng = random.Random(8)
    pool = [" ".join(f"v{k}" for _ in range(n)) for k, n in enumerate((1, 2, 3, 4, 6, 9, 10, 12, 15))] + ["", " "]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9))) for _ in range(40)]
    texts += [f"{pool[7]} x\n{pool[3]} x\n{end}" for end in ("one", "two")]
    want = brute_runs(texts, 10)
    assert want[-1] == {0, 1}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = lines.dedup_lines(docs, 10, detail=True).collect()
    assert {r.doc_id: set(r.removed) for r in found} == dict(enumerate(want))


def test_rows_without_an_id_are_judged_row_by_row(spark):
    shared, other = ("one line of eleven words that stands in " + w + " rows here" for w in ("many", "few"))
    own = [f"line {k} of its own with more than ten words in it {k}" for k in range(6)]
    texts = [f"{own[0]}\n{shared}", f"{shared}\n{own[1]}", f"{own[2]}\n{own[3]}", f"{shared}\n{own[4]}", f"{other}\n{own[5]}", other]
    for key in (None, 7):
        docs = spark.createDataFrame([(key, t) for t in [*texts, texts[2], texts[2]]], "doc_id long, text string")
        found = lines.dedup_lines(docs, 10, detail=True).collect()
        left = [r.text.split("\n") for r in found if r.text]
        # With an id, repeated rows are one document, so each keeps what the first keeps.
        copies = 3 if key else 1
        assert sorted(sum(left, [])) == sorted([shared, other, *own[:2], *own[4:], *own[2:4] * copies])
        assert len(found) == len(texts) + 2
    assert lines.dedup_lines(docs.withColumn("doc_id", F.lit(None).cast("long")), 10).count() == 5


def test_line_runs_reach_over_all_matching_lines(spark):
    shared = "\n".join(f"shared line {k} with six words" for k in range(9))
    docs = spark.createDataFrame([(1, f"first own line\n{shared}"), (2, f"{shared}\nlast own line")], "doc_id long, text string")
    (run,) = lines.repeated_runs(docs, 10).collect()
    assert (run.doc, run["first"], run["last"], run.source, run.source_first) == (2, 0, 8, 1, 1)


# Packing


def test_encoder_equals_the_tokenizer():
    encode = packing.Encoder(packing.tokenizer_path())
    odd = ["don't 's 'll  'lls x''s \n\n a  \t b\n", " ", " \n", "'s", "a's'", "!'s", "x  ", "x \n y", "12a3 ²½ ñandú's 'Re 're're"]
    odd += ["<|endoftext|> a", "　 x", "", "é ‍ 😀😀 's", "a\u0085b", *(t for _, t in sample())]
    for found in ([t] for t in odd):
        assert encode(found)[0].tolist() == encode.tokenizer.encode(found[0], add_special_tokens=False).ids
    ids, begins = encode(odd)
    for k, text in enumerate(odd):
        assert ids[begins[k] : begins[k + 1]].tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_takes_new_words_in_one_result(monkeypatch):
    encode, results = packing.Encoder(packing.tokenizer_path()), []

    class Watched:
        def __init__(self, own):
            self.own = own

        def __getattr__(self, name):
            def call(*args, **options):
                made = getattr(self.own, name)(*args, **options)
                results.extend(made if isinstance(made, list) else [made])
                return made

            return call

    plain, encode.tokenizer = encode.tokenizer, Watched(encode.tokenizer)
    found = [t for _, t in sample()]
    for words in (packing.CACHED_WORDS, 300):
        monkeypatch.setattr(packing, "CACHED_WORDS", words)
        for k in (0, 0, 3, 0):
            ids, begins = encode(found[k:])
            assert np.split(ids, begins[1:-1])[0].tolist() == plain.encode(found[k], add_special_tokens=False).ids
            assert len(ids) == sum(len(e.ids) for e in plain.encode_batch(found[k:], add_special_tokens=False))
    # A result for each text list with new words at most, not one for each word.
    assert len(results) <= 8


def test_fill_is_the_best_subset():
    rng = random.Random(6)
    for _ in range(200):
        items = [rng.randint(1, 20) for _ in range(rng.randint(0, 9))]
        room = rng.randint(0, 60)
        best = max(sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k) if sum(c) <= room)
        chosen = packing.fill(dict(Counter(items)), room)
        assert sum(k * v for k, v in chosen.items()) == best and not chosen - Counter(items)


def test_windows_use_every_piece_once():
    rng = random.Random(8)
    counts = {rng.randint(1, 1024): rng.randint(1, 500) for _ in range(300)}
    made = packing.windows(counts)
    used = Counter()
    for multiset, times in made:
        assert sum(k * v for k, v in multiset.items()) <= 1024
        used.update({k: v * times for k, v in multiset.items()})
    assert used == Counter(counts)
    padding = sum(t * (1024 - s) for m, t in made if (s := sum(k * v for k, v in m.items())) & (s - 1))
    assert padding < 0.02 * sum(k * v for k, v in counts.items())


def test_pack(odd_docs, odd_rows):
    path = packing.tokenizer_path()
    rows = packing.pack(odd_docs, path, with_ids=True).collect()
    encode = packing.Encoder(path).tokenizer.encode
    want = Counter()
    for doc, text, _ in odd_rows:
        ids = [*encode(text or "", add_special_tokens=False).ids, 0]
        for at in range(0, len(ids), 1024):
            raw = np.array(ids[at : at + 1024], "<u4").tobytes()
            want[(doc, at, len(raw) // 4, zlib.crc32(raw), len(ids), raw)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, bytes(r.ids)) for r in rows) == want
    of = defaultdict(list)
    for r in rows:
        of[r.sequence_id].append(r)
    assert sorted(of) == list(range(len(of)))
    for own in of.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    whole = packing.sequences(packing.pack(odd_docs, path, with_ids=True)).collect()
    assert all(len(r.ids) == 4 * r.n_tokens for r in whole)


# Fingerprints


def test_edit_study(odd_docs, odd_rows):
    rows = sorted({(d, t or "") for d, t, _ in odd_rows}, key=lambda r: -r[0])
    made = {r.doc_id: r for r in fingerprints.edit_study(odd_docs.dropDuplicates(["doc_id"])).collect()}
    assert len(made) == len(rows)
    for k, (doc, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[1][:cut]
        r = made[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b = gram_set(text), gram_set(edited)
        likeness = len(a & b) / len(a | b) if a | b else 1.0
        assert abs(r.near_edited - likeness) < 0.3
        assert 0 <= r.near_next <= 1 and (r.near_edited == 1) >= (edited == text)
        assert r.near_next == np.mean([x == y for x, y in zip(parts(r.fingerprint), parts(made[following[0]].fingerprint))])
    for a, b in itertools.combinations(rows, 2):
        if a[1] == b[1]:
            assert made[a[0]].fingerprint == made[b[0]].fingerprint
    assert fingerprints.edit_study(odd_docs).count() == len(odd_rows)


def parts(text):
    return [text[i : i + 8] for i in range(0, len(text), 8)]


def test_near_duplicates(odd_docs, odd_rows):
    sets = {d: gram_set(t) for d, t, _ in odd_rows}
    found = {r.doc_id: r.component for r in fingerprints.near_duplicates(odd_docs).collect()}
    assert set(found) == set(sets)
    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and len(x & y) >= 0.95 * len(x | y):
            assert found[a] == found[b]
        if found[a] == found[b] and x | y:
            assert x & y or found[a] != a


@pytest.mark.parametrize("cell", [fingerprints.CELL_SETS, 1])
def test_pairs_behind_a_less_similar_leader_are_linked(spark, monkeypatch, cell):
    monkeypatch.setattr(fingerprints, "CELL_SETS", cell)
    texts = []
    for k in range(80):
        base = [f"t{k}w{i}" for i in range(116)]
        # The long one holds all of the other two, which are at 0.9 and more to each other but not to it.
        texts += [" ".join(base), " ".join(base[:104]), " ".join(base[5:109])]
    ids = [None if i % 7 == 3 else i for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    raw = [t.encode() for t in texts]
    signed = fingerprints.signatures(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]).astype(np.int64))
    signed = signed.reshape(len(texts), 8, -1)
    sets, links = [gram_set(t) for t in texts], []
    for a, b in itertools.combinations(range(len(texts)), 2):
        if len(sets[a] & sets[b]) >= 0.9 * len(sets[a] | sets[b]) and (signed[a] == signed[b]).all(axis=1).any():
            links.append((a, b))
    assert len(links) > 70
    root = reached(range(len(texts)), links)
    lowest = defaultdict(list)
    for i, r in root.items():
        lowest[r].append(ids[i])
    want = [(ids[i], min((d for d in lowest[r] if d is not None), default=None)) for i, r in root.items()]
    found = [(r.doc_id, r.component) for r in fingerprints.near_duplicates(docs, near=0.9, bands=8).collect()]
    assert Counter(found) == Counter(want)


# Language model


def test_scores(odd_docs, odd_rows):
    rows = language_model.score(odd_docs, bucket_of("doc_id", 7) == 2).collect()
    counts, pairs, starts = Counter(), Counter(), 0
    tokens = {d: [*words(lower(t)), "\n"] for d, t, _ in odd_rows}
    for d, t, _ in odd_rows:
        if bucket(d, 7) != 2:
            counts.update(tokens[d])
            pairs.update(zip(["<s>", *tokens[d]], tokens[d]))
            starts += 1
    n, v = sum(counts.values()), len(counts)
    seen = 1 - sum(c == 1 for c in pairs.values()) / n
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _, _ in odd_rows)
    for r in rows:
        own = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert r.held_out == (bucket(r.doc_id, 7) == 2)
        p = [(counts[w] + 1) / (n + v + 1) for w in own]
        assert math.isclose(r.base_score, sum(map(math.log10, p)), rel_tol=1e-9)
        score = 0.0
        for k, w in enumerate(own):
            h = own[k - 1] if k else "<s>"
            before, pair = (counts[h] if k else starts), pairs[(h, w)]
            kept = 2 ** int(math.log2(pair)) if pair else 0
            score += math.log10(seen * kept / before + (1 - seen) * p[k]) if before else math.log10(p[k])
        assert math.isclose(r.score, score, rel_tol=1e-6)


def test_full_filter_drops_the_rarest_pairs():
    pairs = np.arange(4000, dtype=np.uint64) * np.uint64(2654435761)
    counts = np.where(np.arange(4000) < 300, 40, 1).astype(np.uint64)
    floor, bits = language_model.segment(pairs, counts, 1 << 15)
    model = language_model.Filter(bits, np.array([floor]), 64, 1 << 15)
    model.shift = np.uint64(63)
    assert floor > 1
    assert (model.counts(pairs[:300]) == floor * 2 ** int(math.log2(40 / floor))).all()
    assert (model.counts(pairs[300:]) > 0).mean() < 0.02


def test_a_small_filter_grows_with_the_pairs(odd_docs):
    held = bucket_of("doc_id", 7) == 2
    wide, narrow = (
        sorted((r.doc_id, r.n_tokens, r.score) for r in language_model.score(odd_docs, held, bits).collect())
        for bits in (language_model.FILTER_BITS, 64)
    )
    assert [r[:2] for r in wide] == [r[:2] for r in narrow]
    # No pair is left out, so a text can only score higher, by false positives.
    assert all(b >= a - 1e-6 for (_, _, a), (_, _, b) in zip(wide, narrow))
    counts = np.random.default_rng(4).integers(1, 1000, 5000).astype(np.uint64)
    floor, _ = language_model.segment(np.arange(5000, dtype=np.uint64), counts, language_model.room_for(counts))
    assert floor == 1


# Compression classifier


def test_compression_scores(spark):
    rng = random.Random(5)
    good = [" ".join(rng.choice(("the", "sun", "river", "walks", "under", "stone")) for _ in range(80)) for _ in range(120)]
    bad = [" ".join(rng.choice(("$$$", "WIN!!", "click", "###", "free")) for _ in range(80)) for _ in range(120)]
    rows = [(k, t, int(k < 120)) for k, t in enumerate(good + bad)] + [(900, None, 1), (901, "", 0), (902, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    held = bucket_of("doc_id", 3) == 1
    made = compression.score(docs, compression.fit(docs, docs.filter(~held), "y"), held).collect()
    assert len(made) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in made)
    label = {d: y for d, _, y in rows}
    tested = [r for r in made if r.held_out and r.doc_id < 900]
    assert all(r.held_out == (bucket(r.doc_id, 3) == 1) for r in made)
    assert sum(r.predicted == label[r.doc_id] for r in tested) >= 0.95 * len(tested) > 60
    alone = compression.score(docs, compression.fit(docs, docs.filter("y = 1"), "y"), held).collect()
    assert len({r.score for r in alone}) == 1 and len(alone) == len(rows)


def test_dictionaries_know_the_later_parts_of_texts(spark):
    rng = random.Random(6)
    marks = [[f"{kind}{rng.getrandbits(60):x}" for _ in range(60)] for kind in ("b", "g")]
    rows = []
    for k in range(240):
        body = " ".join(f"{rng.getrandbits(30):x}" for _ in range(700))
        assert len(body) > 4500
        rows.append((k, f"{body} {' '.join(rng.sample(marks[k % 2], 40))}", k % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    held = bucket_of("doc_id", 3) == 1
    made = compression.score(docs, compression.fit(docs, docs.filter(~held), "y"), held).filter("held_out").collect()
    assert sum(r.predicted == r.doc_id % 2 for r in made) >= 0.95 * len(made) > 60


# Empty tables and tables of nulls


@pytest.mark.parametrize("which", EDGES)
def test_edges(which, request):
    docs = request.getfixturevalue(which)
    n = docs.count()
    held = bucket_of("doc_id", 7) == 2
    assert substrings.remove_repeats(docs).filter("n_removed = 0").count() == n
    assert lines.dedup_lines(docs, detail=True).count() == n
    assert lines.dedup_lines(docs).columns == docs.columns
    assert jaccard_join.similarity_groups(docs).count() == n
    assert packing.pack(docs, packing.tokenizer_path()).count() == n
    assert fingerprints.edit_study(docs).count() == n
    assert language_model.score(docs, held).count() == n
    assert compression.score(docs, compression.fit(docs, docs, "size"), held).count() == n
