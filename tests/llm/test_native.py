"""Sharding, mixing and quality rules."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from conftest import WORD, words

from tamiz.llm import mixing, rules, shards


def best_capacity(sizes, k):
    least = sum(sizes)
    for cuts in itertools.combinations_with_replacement(range(len(sizes) + 1), k - 1):
        borders = [0, *cuts, len(sizes)]
        least = min(least, max(sum(sizes[a:b]) for a, b in zip(borders, borders[1:])))
    return least


def test_least_capacity_is_the_best_of_all_cuts():
    rng = random.Random(2)
    for _ in range(60):
        sizes = [rng.choice((1, 2, 5, 30)) * rng.randint(1, 9) for _ in range(rng.randint(1, 8))]
        k = rng.randint(1, 4)
        best = best_capacity(sizes, k)
        assert shards.least_capacity(sizes, k) == best
        cuts = shards.level_cuts(sizes, k)
        borders = [0, *cuts]
        assert borders == sorted(borders) and len(cuts) == k and cuts[-1] == len(sizes)
        assert max(sum(sizes[a:b]) for a, b in zip(borders, borders[1:])) == best
    assert shards.least_capacity([], 3) == 0
    assert shards.level_cuts([], 3) == [0, 0, 0]


def test_shards(odd_docs, odd_rows):
    rows = shards.assign_shards(odd_docs, 5).collect()
    assert len(rows) == len(odd_rows)
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, _ in odd_rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    slots, of_text, load = defaultdict(list), defaultdict(set), Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        of_text[r.text_crc32].add(r.shard)
        load[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_text.values()) and set(slots) <= set(range(5))
    cells = Counter()
    for r in rows:
        cells[r.cell] += r["size"]
    assert max(load.values()) == shards.least_capacity([cells[c] for c in sorted(cells)], 5)


@pytest.mark.parametrize("which", ["no_docs", "null_docs"])
def test_native_operators_on_empty_and_null_tables(which, request):
    docs = request.getfixturevalue(which)
    n = docs.count()
    assert shards.assign_shards(docs, 4).count() == n
    assert mixing.pareto_mix(docs).count() == n
    assert rules.ledger(docs).count() == n
    assert rules.ablations(rules.ledger(docs)).filter("rejected > documents").count() == 0
    assert rules.keep_passing(docs).count() == 0
    assert mixing.mixed(docs).columns == docs.columns


def test_mix(odd_docs, odd_rows):
    rows = mixing.pareto_mix(odd_docs).collect()
    size = Counter()
    for _, t, s in odd_rows:
        size[s] += len(words(t))
    total, left = sum(size.values()), dict(zip(sorted(size, key=lambda s: (s is None, s or "")), itertools.cycle((1, 2, 3))))
    target, rest = {}, float(total)
    while True:
        level = rest / sum(left.values())
        full = [s for s in left if left[s] * level > 3 * size[s]]
        if not full:
            break
        for s in full:
            target[s] = 3.0 * size[s]
            rest -= target[s]
            del left[s]
    target.update({s: w * level for s, w in left.items()})
    taken, largest = Counter(), Counter()
    for r in rows:
        assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        assert r.taken == r["size"] * r.copies <= 3 * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s in size:
        assert abs(taken[s] - target[s]) <= largest[s]
    again = mixing.pareto_mix(odd_docs.repartition(7)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_odds_rank_by_inclusion(spark):
    """With equal sizes each source takes the documents with the smallest draws."""
    docs = spark.createDataFrame([(i, "a b c", f"s{i % 2}") for i in range(200)], "doc_id long, text string, source string")
    draws = {r.doc_id: r.u for r in docs.select("doc_id", mixing.draw("doc_id", "source").alias("u")).collect()}
    rows = mixing.pareto_mix(docs).collect()
    for s in ("s0", "s1"):
        own = sorted((r for r in rows if r.source == s), key=lambda r: draws[r.doc_id])
        copies = [r.copies for r in own]
        assert copies == sorted(copies, reverse=True)
        assert abs(sum(copies) * 3 - own[0].target) <= 3


def copies_of(rows, text=None):
    made = Counter()
    for r in rows:
        made[r.doc_id, r.source, len(words(r.text)) if text else r["size"]] += 1 if text else r.copies
    return +made


def test_mixed_repeats_whole_documents(odd_docs):
    """Rows of one id and source, too: the mix has as many words as the query says."""
    made = mixing.mixed(odd_docs)
    assert made.columns == odd_docs.columns and dict(made.dtypes) == dict(odd_docs.dtypes)
    assert copies_of(made.collect(), "text") == copies_of(mixing.pareto_mix(odd_docs).collect())


@pytest.mark.parametrize("ids", [[7], [7, 8], [None]])
def test_a_cut_among_repeated_rows_is_exact(spark, ids):
    rows = [(ids[k % len(ids)], " ".join(f"w{k % 3}" for _ in range(10)), s, "x", 1, "y") for s, n in (("a", 40), ("b", 40), (None, 9)) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _copy string, _odds int, _doc string").repartition(4)
    made, want = mixing.mixed(docs), mixing.pareto_mix(docs).collect()
    assert made.columns == docs.columns
    assert copies_of(made.collect(), "text") == copies_of(want)
    for s in ("a", "b", None):
        own = [r for r in want if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 10


def brute_rules(text):
    text = text or ""
    found = WORD.findall(text)
    seen = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    covered = {p for i in range(len(found) - 7) if seen[tuple(found[i : i + 8])] > 1 for p in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(found),
        sum(map(len, found)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_rules(spark, odd_docs, odd_rows):
    more = ["a b c d e f g h " * 3, "#|* <> & one\none\none $5", "x\x0by\x0cz\rq\n\n", "    é"]
    extra = spark.createDataFrame([(200 + k, t) for k, t in enumerate(more)], "doc_id long, text string")
    judged = rules.ledger(odd_docs.select("doc_id", "text").union(extra))
    want = Counter((d, *brute_rules(t)) for d, t, _ in [*odd_rows, *((200 + k, t, None) for k, t in enumerate(more))])
    rows = judged.collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    for r in rows:
        assert bool(r.fail_bits & 1) == (r.n_words < 20)
        assert bool(r.fail_bits & 2) == (100 * r.n_repeat_words > 30 * r.n_words)
    kept = rules.keep_passing(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = {r.doc_id for r in rows if not r.fail_bits}
    assert {r.doc_id for r in kept.collect()} == {i for i in ids if i < 200}


def test_ablations(odd_docs):
    judged = rules.ledger(odd_docs)
    bits = [r.fail_bits for r in judged.collect()]
    for r in rules.ablations(judged).collect():
        policy = next(p for p in rules.POLICIES if (p.name, p.version) == (r.policy, r.version))
        bit = 1 << list(rules.RULES).index(r.rule)
        assert r.documents == len(bits)
        assert r.rejected == sum(b & policy.mask != 0 for b in bits)
        assert r.failed == sum(b & bit != 0 for b in bits)
        assert r.rejected_alone == sum(b & policy.mask == bit for b in bits)


@pytest.mark.parametrize("name", ["op4_pareto_mix", "op6_rule_ledger"])
def test_queries_with_sql(spark, name):
    from check import as_rows
    from tamiz.llm.registered import CHECK_SQL, QUERIES

    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    frame = QUERIES[name](spark, sf)
    cursor = db.execute(CHECK_SQL[name])
    assert as_rows(frame.columns, frame.collect()) == as_rows([d[0] for d in cursor.description], cursor.fetchall())
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("CartesianProduct", "NestedLoopJoin", "Python", "Arrow", "InPandas"))
