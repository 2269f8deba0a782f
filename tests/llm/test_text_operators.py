from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from silverlode.llm import lengths, mixing, neardup, packing, passages, quality, token_files, tokens, toxicity
from silverlode.llm.oracle import ORACLE_SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def direct_ids(name: str, text: str | None) -> list[int]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.tokenizer_path(name))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_ids_equal_direct_ids(name, odd):
    texts = [r.text for r in odd.collect()] + [
        "It's don't 'S we'll  x\n\n y\t z 12ab ² ½ a_b '' ''s \x1c q", "  ", "İ ΣΑΣ é <|endoftext|> 日本語 😀", "x\r\n y '", "—‘q’s €5 \xa0b\x85",
    ]
    encoder = tokens.encoder(tokens.tokenizer_path(name))
    for _ in range(2):
        assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(texts)] == [direct_ids(name, t) for t in texts]


def test_toxicity_learns_from_its_part_only(spark, odd, empty, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in found.items())
    held = [(r.toxic, found[r.doc_id].predicted) for r in labels.collect() if r.doc_id in found and found[r.doc_id].held_out]
    assert sum(p for t, p in held if not t) == 0
    assert sum(p for t, p in held if t) >= 0.5 * sum(t for t, _ in held)
    scores = toxicity.toxicity(odd, labels)
    assert scores.count() == odd.count() and scores.where("score is null or held_out is null").isEmpty()
    assert toxicity.toxicity(empty, labels).isEmpty()
    assert toxicity.toxicity(odd, labels.where("false")).select("score").distinct().count() == 1


def test_identity_swaps_hold_the_score_still():
    assert toxicity.swapped_sentences("The Muslim man left. Nothing here.") == [("the muslim man left", "the christian girl left")]
    import pandas as pd

    def sets(texts):
        import pyarrow as pa

        return [s.view(np.int64) for s in toxicity._sets(pa.array(texts))]

    # "muslim" goes with label 1 by accident, "idiot" by cause.
    texts = ["idiot muslim here"] * 40 + ["idiot there"] * 20 + ["muslim there"] * 5 + ["plain christian here"] * 60
    frame = pd.DataFrame({"label": [1.0] * 60 + [0.0] * 65, "plus": sets(texts), "minus": None})
    before, after = sets(["muslim here", "christian here"])
    pair = pd.DataFrame({"label": [None], "plus": [np.setdiff1d(before, after)], "minus": [np.setdiff1d(after, before)]})

    def change(model):
        weight = dict(zip(model.features.view(np.int64).tolist(), model.weights))
        return abs(sum(weight.get(f, 0) for f in before.tolist()) - sum(weight.get(f, 0) for f in after.tolist()))

    assert change(toxicity.fit(pd.concat([frame, pair]))) < 0.5 * change(toxicity.fit(frame))


def test_quality_equals_sql(spark, odd, empty, documents):
    for docs in (odd, documents):
        rows = docs.select("doc_id", "text", "lang", "source").toPandas()
        con = duckdb.connect()
        con.register("documents", rows)
        expected = con.execute(ORACLE_SQL["op2_quality_rules"]).fetchall()
        found = quality.judge(docs).select("doc_id", "quality.*").collect()
        assert sorted(map(repr, map(tuple, found))) == sorted(repr((None if r[0] != r[0] else r[0] if r[0] is None else int(r[0]), *r[1:])) for r in expected)
    kept = quality.reject_low_quality(odd)
    assert kept.columns == odd.columns
    assert quality.reject_low_quality(empty).isEmpty()
    assert not {4, 5, 6, 8, 10} & {r.doc_id for r in kept.collect()}


def test_length_histogram_answers_every_limit(spark, odd, empty, documents):
    docs = documents.select("text").union(odd.select("text"))
    sizes = [len(direct_ids("byte_bpe_50k.json", r.text)) for r in docs.collect()]
    found = lengths.length_histogram(docs)
    for r in found.collect():
        assert r.n_docs == sizes.count(r.length)
        assert r.docs_at_least == sum(s >= r.length for s in sizes)
        assert r.truncated_total == sum(min(s, r.length) for s in sizes)
        assert r.total_tokens == sum(sizes)
    assert lengths.truncated_total(found, 100) == sum(min(s, 100) for s in sizes)
    assert lengths.quantile(found, 0.5) == sorted(sizes)[(len(sizes) + 1) // 2 - 1]
    assert lengths.length_histogram(empty).isEmpty()


def test_packing_places_every_id_once(odd, empty):
    pieces = packing.pack(odd).collect()
    texts = Counter((r.doc_id, tuple([*direct_ids("byte_bpe_50k.json", r.text), 1])) for r in odd.collect())
    by_id = {d: ids for d, ids in texts}
    for p in pieces:
        assert p.ids_crc32 == crc(by_id[p.doc_id][p.start : p.start + p.length]) and p.offset + p.length <= 2048
    assert sum(p.length for p in pieces) == sum(len(ids) * n for (_, ids), n in texts.items())
    end = 0
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert (p.sequence_id * 2048 + p.offset) == end
        end += p.length
    assert packing.pack(empty).isEmpty()


def test_hilbert_neighbours_are_adjacent():
    side = np.arange(8)
    cells = np.array(np.meshgrid(side, side, side)).reshape(3, -1).T
    keys = packing.hilbert_key(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 70000), st.integers(0, 2**64 - 1), st.just(0)), max_size=700), st.sampled_from([7, 64, 256]))
def test_simple8b_round_trip(values, block):
    words, blocks = token_files.encode(np.array(values, np.uint64), block)
    assert token_files.decode(words, blocks, len(values), block).tolist() == values


def test_token_files_round_trip(odd, empty):
    found = token_files.round_trip(odd).collect()
    expected = sorted(((r.doc_id is not None, r.doc_id or 0, [*direct_ids("word_bpe_49k.json", r.text), 2]) for r in odd.collect()))
    start = 0
    for r, (known, doc_id, ids) in zip(sorted(found, key=lambda r: r.start), expected, strict=True):
        assert (r.doc_id if known else 0) == doc_id and r.start == start and np.frombuffer(r.ids, "<u4").tolist() == ids
        start += len(ids)
    assert token_files.round_trip(empty).isEmpty()


def weighted_classes(docs):
    """Brute force: TF-IDF weighted Jaccard of all pairs, then components."""
    bags = {}
    for r in docs.collect():
        w = WORD.findall((r.text or "").lower())
        if w and r.doc_id is not None:
            bags[r.doc_id] = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
    df = Counter(s for b in bags.values() for s in b)
    n = sum(1 for r in docs.collect() if WORD.search(r.text or ""))
    idf = lambda s: np.log(1 + n / max(df[s], n / 20))
    weights = {d: {s: (1 + np.log(c)) * idf(s) for s, c in b.items()} for d, b in bags.items()}
    root = {d: d for d in bags}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    holders = defaultdict(list)
    for d, b in bags.items():
        for s in b:
            holders[s].append(d)
    for a, b in {(a, b) for h in holders.values() for a in h for b in h if a < b}:
        low = sum(min(w, weights[b].get(s, 0)) for s, w in weights[a].items())
        if low >= 0.8 * (sum(weights[a].values()) + sum(weights[b].values()) - low):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: find(d) for d in bags}


def test_near_duplicates_equal_brute_force(odd, empty, documents):
    for docs in (odd, documents):
        found = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
        assert {d: c for d, c in found.items() if d in (known := weighted_classes(docs))} == known
    by_id = {r.doc_id: r for r in neardup.near_duplicates(odd).collect()}
    assert by_id[2].class_id == by_id[3].class_id == 1 and by_id[4].class_id == 4 and by_id[None].class_id is None and by_id[None].kept
    kept = neardup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 8, 9, 10, 11]
    assert neardup.drop_near_duplicates(empty).isEmpty()


def test_large_bands_are_compared_whole(spark, monkeypatch):
    """A group far larger than a block, whose members reach each other only through some of them."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for d in range(60):
        text = list(base)
        for i in rng.choice(150, d % 7, replace=False):
            text[i] = f"e{d}_{i}"
        rows.append((d, " ".join(text)))
    rows += [(100 + d, " ".join(f"f{d}_{i}" for i in range(50))) for d in range(1300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()} == weighted_classes(docs)


def test_passages_are_cut_once(odd, empty, documents):
    found = {r.doc_id: r for r in passages.cut_passages(odd).collect()}
    assert found[2].text == "" and found[1].passages is None and found[1].text
    assert WORD.findall(found[9].text)[:60] == WORD.findall({r.doc_id: r for r in odd.collect()}[9].text)[:60]
    assert found[9].passages[0].others == [1] and found[4].text is None and found[None].passages is None
    assert passages.cut_passages(empty).isEmpty()
    cut = {r.doc_id: r.text for r in passages.cut_passages(documents).collect()}
    holders = defaultdict(set)
    for d, text in cut.items():
        w = WORD.findall(text.lower())
        for i in range(len(w) - 49):
            holders[tuple(w[i : i + 50])].add(d)
    assert all(len(h) == 1 for h in holders.values())


def test_chain_equals_quadratic_search():
    rng = np.random.default_rng(5)
    for _ in range(20):
        x, y = rng.choice(200, 12, replace=False), rng.choice(200, 12)
        best = {}
        for i in np.argsort(x, kind="stable"):
            before = [best[j] - passages.GAP_COST * ((x[i] - x[j]) + (y[i] - y[j])) for j in best if x[j] < x[i] and y[j] < y[i]]
            best[i] = passages.KMER + max([0.0, *before])
        found = passages.chain(x, y)[0]
        score = passages.KMER * len(found) - passages.GAP_COST * ((x[found[-1]] - x[found[0]]) + (y[found[-1]] - y[found[0]]))
        assert abs(score - max(best.values())) < 1e-9


def test_mixing_meets_targets(odd, empty, documents):
    for docs in (odd, documents):
        rows = mixing.mixing_plan(docs).collect()
        assert rows == mixing.mixing_plan(docs).collect() or sorted(map(repr, rows)) == sorted(map(repr, mixing.mixing_plan(docs).collect()))
        sizes = sorted((len(WORD.findall(r.text or "")) for r in docs.collect()))
        assert sorted(r["size"] for r in rows) == sizes
        assert all(r.taken <= 3 * r["size"] for r in rows)
    sources = {}
    for r in documents.collect():
        sources.setdefault(r.source, []).append(len(WORD.findall(r.text or "")))
    names = sorted(sources)
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    total, capped = sum(map(sum, sources.values())), set()
    while True:
        left = total - sum(3 * sum(sources[n]) for n in capped)
        level = left / max(1, sum(weight[n] for n in names if n not in capped))
        over = {n for n in names if n not in capped and weight[n] * level > 3 * sum(sources[n])}
        if not over:
            break
        capped |= over
    target = {n: 3.0 * sum(sources[n]) if n in capped else weight[n] * level for n in names}
    source_of = {r.doc_id: r.source for r in documents.collect()}
    taken = Counter()
    for r in mixing.mixing_plan(documents).collect():
        assert abs(r.target - target[source_of[r.doc_id]]) < 1e-6 * total
        taken[source_of[r.doc_id]] += r.taken
    for n in names:
        assert abs(taken[n] - target[n]) <= max(sources[n])
    mixed = mixing.mix(documents)
    assert mixed.columns == documents.columns
    assert mixing.mix(empty).isEmpty()


def test_splitting_tree_keeps_quotas(spark):
    quotas = spark.createDataFrame([(0, 5000), (1, 3), (2, 700), (3, 0)], "s int, quota long")
    leaves = mixing.split_quotas(quotas, 4).collect()
    assert Counter({r.s: 0 for r in leaves}) | Counter() == Counter()
    total, shard = Counter(), Counter()
    for r in leaves:
        total[r.s] += r.quota
        shard[r.shard] += r.quota
    assert total == {0: 5000, 1: 3, 2: 700} and max(shard.values()) - min(shard.values()) <= 1
    share = [r.quota for r in leaves if r.s == 2]
    assert 20 < np.mean(share) < 70 and len(set(share)) > 3


def fresh(rng, count: int) -> list[str]:
    return [f"v{i}" for i in rng.integers(0, 10**9, count)]


def test_fuzzy_passages_are_recalled(spark):
    """Passages with a changed word every 17 words, and with 5, 10 and 15 % of the words changed at random."""
    rng = np.random.default_rng(11)
    rows, planted = [], {}
    for rate, least in (("17", 1.0), (0.05, 0.9), (0.1, 0.9), (0.15, 0.4)):
        for _ in range(40):
            passage = fresh(rng, 120)
            edits = np.arange(17, 120, 18) if rate == "17" else np.flatnonzero(rng.random(120) < rate)
            copy = list(passage)
            for i in edits:
                copy[i] = fresh(rng, 1)[0]
            doc = len(rows)
            rows += [(doc, " ".join(fresh(rng, 30) + passage + fresh(rng, 30))), (doc + 1, " ".join(fresh(rng, 50) + copy + fresh(rng, 50)))]
            planted[doc + 1] = (rate, least, len(edits))
    found = {r.doc_id: r.passages for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    shares, leasts = defaultdict(list), {}
    for doc, (rate, least, _) in planted.items():
        inside = sum(max(0, min(p.end, 170) - max(p.begin, 50)) for p in found[doc] or [])
        shares[rate].append(inside / 120)
        leasts[rate] = least
    recall = {rate: np.mean(np.array(s) >= 0.5) for rate, s in shares.items()}
    assert all(recall[r] >= leasts[r] for r in recall), recall
    assert min(shares["17"]) >= 0.8, shares["17"]
    assert all(found[d - 1] is None for d in planted)


def test_a_passage_quoted_before_in_part_is_found(spark):
    rng = np.random.default_rng(12)
    rows = []
    for doc in range(0, 80, 2):
        passage = fresh(rng, 50)
        rows.append((doc, " ".join(fresh(rng, 20) + passage + fresh(rng, 20))))
        rows.append((doc + 1, " ".join(passage[:30] + fresh(rng, 60) + passage + fresh(rng, 60))))
    found = {r.doc_id: r.passages for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all([(p.begin, p.end) for p in found[d] or []] == [(90, 140)] for d in range(1, 80, 2)), found


def test_pieces_hold_the_ids_of_whole_sequences(odd):
    sequences = defaultdict(list)
    for p in sorted(packing.pack(odd).collect(), key=lambda p: (p.sequence_id, p.offset)):
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length and p.ids_crc32 == crc(ids)
        sequences[p.sequence_id] += ids.tolist()
    *full, last = [sequences[i] for i in range(len(sequences))]
    assert all(len(s) == 2048 for s in full) and 0 < len(last) <= 2048
    documents = " ".join(map(str, sum(sequences.values(), []))).split(" 1 ")
    texts = Counter(" ".join(map(str, direct_ids("byte_bpe_50k.json", r.text))) for r in odd.collect() if r.text)
    assert texts - Counter(d.removesuffix(" 1") for d in documents) == Counter()


def test_patchwork_of_shorter_stretches_is_no_passage(spark):
    """Texts whose stretches of 16, 12 and 8 words stand in different earlier documents stay whole."""
    rng = np.random.default_rng(13)
    rows, later = [], []
    for size in (16, 12, 8):
        for _ in range(20):
            stretches = [fresh(rng, size) for _ in range(60 // size + 1)]
            for stretch in stretches:
                rows.append((len(rows), " ".join(fresh(rng, 40) + stretch + fresh(rng, 40))))
            later.append(" ".join(fresh(rng, 20) + sum(stretches, [])[:60] + fresh(rng, 20)))
    rows += [(10_000 + i, text) for i, text in enumerate(later)]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).where("passages is not null")
    assert found.isEmpty(), found.select("doc_id", "passages").collect()


def test_copies_made_of_known_phrases_are_found(spark):
    """Exact copies whose every short seed stands in yet earlier documents."""
    rng = np.random.default_rng(14)
    phrases = [fresh(rng, 8) for _ in range(150)]
    rows = [(d, " ".join(sum((phrases[i] for i in rng.permutation(150)[:60]), []))) for d in range(30)]
    planted = {}
    for k in range(20):
        passage = sum((phrases[i] for i in rng.permutation(150)[:8]), [])[:60]
        rows.append((1000 + k, " ".join(fresh(rng, 30) + passage + fresh(rng, 30))))
        rows.append((2000 + k, " ".join(fresh(rng, 50) + passage + fresh(rng, 50))))
        planted[2000 + k] = (50, 110)
    found = {r.doc_id: r.passages for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    shares = [sum(max(0, min(p.end, b) - max(p.begin, a)) for p in found[d] or []) / (b - a) for d, (a, b) in planted.items()]
    assert min(shares) == 1.0, shares
    outside = [sum(p.end - p.begin for p in found[d] or []) - 60 for d in planted]
    assert max(outside) <= 0, outside


def test_copies_are_found_whoever_holds_their_seeds_before(spark):
    """Exact 40-word copies, while each 39 words of them stand in yet earlier documents, or twice in one."""
    rng = np.random.default_rng(15)
    rows, planted = [], {}
    for k in range(30):
        passage = fresh(rng, 40)
        parts = [passage[:39], passage[1:], passage[4:30]]
        if k % 2:
            rows += [(3 * k + i, " ".join(fresh(rng, 30) + p + fresh(rng, 30))) for i, p in enumerate(parts)]
            rows.append((1000 + k, " ".join(fresh(rng, 20) + passage + fresh(rng, 20))))
        else:  # the first document has the whole passage too, behind its parts
            rows.append((3 * k, " ".join(sum((fresh(rng, 30) + p for p in [*parts, passage]), []) + fresh(rng, 30))))
        for doc, lead in ((2000 + k, 50), (3000 + k, 60), (4000 + k, 0)):
            rows.append((doc, " ".join(fresh(rng, lead) + passage + fresh(rng, 25))))
            planted[doc] = [(lead, lead + 40)]
    found = {r.doc_id: r.passages for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: [(p.begin, p.end) for p in found[d] or []] for d in planted} == planted
    assert not any(p for d, p in found.items() if d not in planted)


CLASHES = "doc_id long, text string, lang string, source string, `meta.a` string, _shard string, _copy string, _mix string, _order string, " + \
    "_t string, _s string, t string, s string, d string, block string, draws string, _spans string, _span_doc string, _fences string, _quality_verdict string, _passages_cut string"


def test_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline

    text = " ".join(f"word{i} of" for i in range(60))
    rows = [(i, text + f" end{i}", "en", "a", *["x"] * 17) for i in range(3)] + [(None, None, None, None, *["y"] * 17)]
    docs = spark.createDataFrame(rows, CLASHES)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, "")
        assert kept.columns == docs.columns, name
        assert {tuple(r)[4:] for r in kept.collect()} <= {("x",) * 17, ("y",) * 17}, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0


def test_training_rows_are_bounded_by_ids(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 10)
    docs = spark.createDataFrame([(i % 3, f"text {i}") for i in range(900)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(3)], "doc_id long, toxic int")
    sample = toxicity.training_sample(docs, labels)
    assert len(sample) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(3))
