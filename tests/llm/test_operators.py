"""Corpus operators on Spark: brute-force versions, edge rows, oracles, guards."""

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
import corpus_pipeline
from jornada.llm import (decontaminate, html_extract, katz, language_id, mixing, near_dup, pii,
                         quality_rules, rule_ensemble, token_store)
from jornada.llm.oracles import ORACLE_SQL
from jornada.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
PROSE = " ".join(f"alpha{i} beta{i % 7} gamma{i % 11}" for i in range(40))
ROWS = [(1, None, None, None, 0, "a"), (2, "", "en", "s", 0, None), (3, "One", "en", "s", 3, "b"),
        (4, PROSE, "en", "s", 9, "c"), (5, PROSE, None, "t", 9, "c"), (6, PROSE + " more", "en", None, 9, "d"),
        (7, LONG, "en", "t", 9, "e"), (8, "the end", "en", "s", 7, "f"), (8, "the end", "en", "s", 7, "f"),
        (None, "no id here", "en", "s", 7, "g")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def canon(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows),
                  key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for view in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{SF_SMALL}/{view}.parquet')")
    rel = con.sql(ORACLE_SQL[name])
    df = QUERIES[name](spark, SF_SMALL).select(*rel.columns)
    assert canon(df.collect()) == canon(rel.fetchall())


def test_quality_edges_and_ablation(docs, empty):
    rows = quality_rules.apply_policy(quality_rules.ledger(docs)).collect()
    assert len(rows) == len(ROWS) and {r.n_words for r in rows if r.doc_id in (1, 2)} == {0}
    assert {r.doc_id for r in rows if r.kept} == {4, 5, 6, 7}
    assert quality_rules.ledger(empty).count() == 0
    led = quality_rules.ledger(docs)
    by = {r.rule: r for r in quality_rules.ablation(led).collect()}
    fails = led.where(F.expr("fail_bits & 1 <> 0")).count()
    assert by["few_words"].fails == fails and by["few_words"].kept_without >= 4


def _targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > 2 * sizes[s]]
        if not over:
            out.update({s: left * w[s] / total for s in free})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def test_mixing_targets_and_copies(spark, docs, empty):
    for sf in (spark.read.parquet(f"{SF_SMALL}/documents.parquet"), docs):
        rows = mixing.plan(sf).collect()
        sizes = Counter()
        for r in rows:
            sizes[r.source] += r.size
        for r in rows:
            assert r.target == pytest.approx(_targets(dict(sizes))[r.source])
            assert 0 <= r.taken <= 2 * r.size
        taken, most = Counter(), Counter()
        for r in rows:
            taken[r.source] += r.taken
            most[r.source] = max(most[r.source], r.size)
        for r in rows:
            assert abs(taken[r.source] - r.target) <= most[r.source] + 1e-6
        again = Counter((r.doc_id, r.source, r.copies) for r in mixing.plan(sf).collect())
        assert again == Counter((r.doc_id, r.source, r.copies) for r in rows)
        copies = Counter()
        for r in rows:
            copies[r.doc_id, r.source] += r.copies
        mixed = Counter((r.doc_id, r.source) for r in mixing.mix(sf).collect())
        assert mixed == +copies
    assert mixing.plan(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_token_store_round_trip(spark, docs, empty, workdir):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(token_store.default_vocabulary())
    path = f"{workdir}/tokens"
    token_store.write_tokens(docs, path)
    got = sorted(token_store.read_documents(spark, path).collect(), key=lambda r: r.start)
    start = 0
    for r, row in zip(got, sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))):
        ids = tok.encode(row[1] or "", add_special_tokens=False).ids + [0]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (row[0], start, len(ids), crc)
        start += len(ids)
    assert len(got) == len(ROWS)
    token_store.write_tokens(empty, f"{workdir}/none")
    assert token_store.read_documents(spark, f"{workdir}/none").count() == 0


def test_decontamination(spark, docs, empty):
    item = " ".join(PROSE.split()[10:30])
    bench = spark.createDataFrame([(1, item.upper().replace(" ", "  ")), (2, None), (3, "the end")],
                                  "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    assert found == {(4, 1), (5, 1), (6, 1), (8, 3)}
    assert {r.doc_id for r in decontaminate.clean(docs, bench).collect()} == {1, 2, 3, 7, None}
    small = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench, block_bytes=8).collect()}
    assert small == found
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(ROWS)
    assert decontaminate.matches(empty, bench).count() == 0


def _components(rows, size):
    sets = {}
    for doc, text in rows:
        w = words(text)
        sets[doc] = frozenset(zip(*(w[i:] for i in range(size)))) if len(w) >= size else frozenset([tuple(w)] if w else [])
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    index = defaultdict(list)
    for d in sorted(sets):
        shared = Counter(o for s in sets[d] for o in index[s])
        for o, k in shared.items():
            if 100 * k >= 80 * (len(sets[d]) + len(sets[o]) - k):
                a, b = find(d), find(o)
                parent[max(a, b)] = min(a, b)
        for s in sets[d]:
            index[s].append(d)
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, docs, empty, size):
    small = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    chain = [(10_000 + i, " ".join(f"k{j}" for j in range(4 * i, 4 * i + 60))) for i in range(12)]
    rows = [tuple(r) for r in small.collect()] + chain
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), size).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _components(rows, size)
    if size == 2:
        edge = {r.doc_id: r for r in near_dup.near_duplicates(docs).collect()}
        assert edge[1].n_shingles == edge[2].n_shingles == 0 and edge[5].component_id == 4
        assert edge[6].component_id == 4 and edge[3].kept and not edge[6].kept
        assert near_dup.near_duplicates(empty).count() == 0


def test_near_duplicates_beyond_the_likeliest_pairs(spark, monkeypatch):
    # 4, 5 and 6, 7 are linked, and so are 4 and 6; but in sketches 4 is likest 7 and
    # 5 is likest 6, which are below 0.8. 1 leads their buckets and is like none.
    w = [f"w{i}" for i in range(200)]
    y, u, v = ([f"{c}{i}" for i in range(18)] for c in "yuv")
    rows = [(1, " ".join(f"o{i}" for i in range(2500))), (4, " ".join(w)), (5, " ".join(w[:-10] + u[:10])),
            (6, " ".join(y + w[18:])), (7, " ".join(y + w[18:-10] + v[:10]))]
    base = np.arange(1000, 1000 + near_dup.M, dtype=np.uint16)
    other = base.reshape(near_dup.BANDS, -1).copy()
    other[16:, 0] += np.where(np.arange(16) % 2, 2, -2).astype(np.uint16)
    regs = {4: base.copy(), 5: other.reshape(-1).copy(), 6: other.reshape(-1), 7: base, 1: base.copy()}
    regs[4][:5] = regs[5][:5] = np.array([900, 1100, 900, 1100, 900])
    regs[1][:5] = regs[1][80:] = 50
    regs = spark.createDataFrame([(i, bytearray(r.tobytes())) for i, r in regs.items()], "doc_id bigint, regs binary")
    real = near_dup.sketch
    monkeypatch.setattr(near_dup, "sketch", lambda *a: real(*a).drop("regs").join(regs, "doc_id"))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _components(rows, 2)
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 4: 4, 5: 4, 6: 4, 7: 4}


def test_deduplicate_drops_only_copies(spark):
    text = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcdefg"]
    near = text[0] + " more"
    rows = [(None, text[1]), (None, text[2]), (None, text[2]), (None, near), (1, text[0]),
            (7, text[3]), (7, text[4]), (7, text[4].upper()), (7, text[4]), (8, text[4] + " x"), (9, text[5]),
            (None, None), (None, None), (None, ""), (2, ""), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = Counter((r.doc_id, (r.text or "").lower()) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert got == Counter([(None, text[1]), (None, text[2]), (1, text[0]), (7, text[3]), (7, text[4]), (9, text[5]),
                           (None, ""), (None, ""), (None, ""), (2, "")])
    rows = near_dup.near_duplicates(docs, 5).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {
        (None, None), (None, 1), (1, 1), (7, 7), (8, 7), (9, 9), (2, 2)}


def _katz_brute(rows):
    """score per text, from dictionaries."""
    train = [words(t) for _, t, held in rows if not held]
    uni, bi = Counter(), Counter()
    for w in train:
        seq = [*w, "</s>"]
        uni.update(seq)
        bi.update(zip(["<s>", *seq], seq))
    hist = lambda c: dict(Counter(v for v in c.values() if v <= katz.K + 1))
    du, db = katz.discounts(hist(uni)), katz.discounts(hist(bi))
    cut = lambda c, d: d[c - 1] * c if c <= katz.K else c
    n = sum(uni.values())
    p = {w: cut(c, du) / n for w, c in uni.items()}
    unknown = 1 - sum(p.values())
    ctx = defaultdict(lambda: [0, 0.0, 0.0])
    for (h, w), c in bi.items():
        x = ctx[h]
        x[0] += c
        x[1] += cut(c, db)
        x[2] += p[w]

    def prob(h, w):
        low = p.get(w, unknown)
        if h not in ctx:
            return low
        total, kept, seen = ctx[h]
        scale = total / (total + 1) if kept > total - 1e-9 else 1.0
        if (h, w) in bi:
            return cut(bi[h, w], db) * scale / total
        return (1 - kept * scale / total) / max(1 - seen, 1e-12) * low
    for h in list(ctx)[:20]:
        assert sum(prob(h, w) for w in uni) + prob(h, "never seen") == pytest.approx(1.0)
    out = {}
    for d, t, _ in rows:
        seq = [*words(t), "</s>"]
        out[d] = (len(seq), sum(w in uni for w in seq), n,
                  sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (len(uni) + 1))) for w in seq),
                  sum(math.log10(prob(h, w)) for h, w in zip(["<s>", *seq], seq)))
    return out


def test_katz_equals_brute_force(spark, empty):
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
            for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows += [(-1, None, False), (-2, "zzz yyy", True)]
    got = katz.score(spark.createDataFrame(rows, "doc_id bigint, text string, held_out boolean")).collect()
    expected = _katz_brute(rows)
    assert len(got) == len(rows)
    for r in got:
        e = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == e[:3]
        assert r.base_score == pytest.approx(e[3]) and r.score == pytest.approx(e[4])
    assert katz.score(empty.select("doc_id", "text", F.lit(False).alias("held_out"))).count() == 0


def test_katz_over_many_blocks_and_buckets(spark, monkeypatch):
    rows = [(r.doc_id, r.text, r.doc_id % 10 == 0)
            for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    # "qu ack" always follow each other, often: a context that no discount frees
    rows += [(-10 - i, "qu ack " * 8, False) for i in range(6)] + [(-30, "qu ack qu unknown", True)]
    monkeypatch.setattr(katz, "BUCKET_BYTES", 30_000)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, held_out boolean").repartition(5)
    got = katz.score(docs).collect()
    expected = _katz_brute(rows)
    assert len(got) == len(rows)
    for r in got:
        e = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == e[:3]
        assert r.base_score == pytest.approx(e[3]) and r.score == pytest.approx(e[4])


def test_katz_blocks_ask_only_buckets_they_have_keys_of():
    docs = pa.RecordBatch.from_pydict(
        {"doc_id": [1, 2], "held_out": [False, True], "text": ["a b a b", "a c"]}, katz._DOCS)
    block = pa.RecordBatch.from_pydict({"block": [5], "docs": [katz._packed_docs([docs])]})
    few, many = (pa.Table.from_batches(katz._asked(n)(iter([block]))) for n in (1, 1 << 30))
    # 4 words with the end and 7 pairs with the start: a row each at most
    assert few.num_rows == 1 and many.num_rows <= 11
    for keys, n, training in (("words", "word_n", 5), ("pairs", "pair_n", 5)):
        listed = [np.concatenate([katz.unpack_keys(k.as_py()) for k in t[keys]]).tolist() for t in (few, many)]
        assert listed[0] == listed[1] == sorted(listed[0])
        assert [sum(int(katz.unpack_counts(c.as_py()).sum()) for c in t[n]) for t in (few, many)] == [training] * 2


def test_katz_scores_every_row_on_its_own(spark):
    texts = ["a b c d", "a b c d", "b c x", None, "qq a c"] * 3
    keyed = [(i, t, i % 5 == 4) for i, t in enumerate(texts)]
    expected = _katz_brute(keyed)
    rows = [((None, 7)[i % 2], t, h) for i, t, h in keyed]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, held_out boolean").repartition(2)
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6))
           for r in katz.score(docs).collect()]
    assert Counter(got) == Counter(
        ((None, 7)[i % 2], h, *expected[i][:2], *(round(x, 6) for x in expected[i][3:])) for i, _, h in keyed)


def test_html_pages(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<body><nav>menu</nav><main><p>kept text</p></main></body>"), (2, "v", None), (3, "w", "")],
        "page_id bigint, url string, html string")
    rows = {r.page_id: (r.text, r.n_chars) for r in
            html_extract.extract_pages(pages, html_extract.train(pages)).collect()}
    assert rows == {1: ("kept text", 9), 2: ("", 0), 3: ("", 0)}
    assert html_extract.extract_pages(pages.limit(0), {}).count() == 0


def test_classifiers(spark, docs, empty):
    small = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = language_id.train(small.where("doc_id % 2 = 0"))
    rows = language_id.predict(small.where("doc_id % 2 = 1"), model).join(small.select("doc_id", "lang"), "doc_id")
    assert rows.where("lang_pred = lang").count() >= 0.95 * rows.count()
    edge = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert edge[1].lang_pred == edge[2].lang_pred == "und" and edge[1].score == 0
    assert language_id.train(empty) is None and language_id.predict(docs, None).where("lang_pred <> 'und'").isEmpty()
    stats = rule_ensemble.statistics(docs)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in rule_ensemble.predict(stats, rule_ensemble.train(stats, none)).collect()} == {0.5}
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    stats = rule_ensemble.statistics(small)
    got = rule_ensemble.predict(stats, rule_ensemble.train(stats, labels)).join(labels, "doc_id")
    assert got.where("predicted = quality").count() >= 0.95 * got.count()


def test_samples_stay_bounded_where_rows_repeat(spark, monkeypatch):
    text = {"en": "the cat and the dog sat on the mat", "fr": "le chat et le chien sont sur le tapis"}
    rows = spark.range(20_000).select(
        F.lit(7).cast("long").alias("doc_id"), F.when(F.col("id") % 20 == 0, "fr").otherwise("en").alias("lang"))
    rows = rows.withColumn("text", F.when(F.col("lang") == "fr", text["fr"]).otherwise(text["en"]))
    sizes = []
    fitted = language_id.Model
    monkeypatch.setattr(language_id, "Model", lambda x, langs: sizes.append(len(x)) or fitted(x, langs))
    model = language_id.train(rows, per_language=300)
    assert 400 < sizes[0] < 800
    got = language_id.predict(spark.createDataFrame([(1, text["en"]), (2, text["fr"])], "doc_id bigint, text string"), model)
    assert {r.doc_id: r.lang_pred for r in got.collect()} == {1: "en", 2: "fr"}

    stats = rule_ensemble.statistics(rows.select("doc_id", "text"))
    drawn = []
    extract = rule_ensemble.extract_rules
    monkeypatch.setattr(rule_ensemble, "extract_rules", lambda x, y: drawn.append(len(x)) or extract(x, y))
    labels = spark.createDataFrame([(7, 1), (7, 0), (7, None)], "doc_id bigint, quality int")
    rule_ensemble.train(stats, labels, max_rows=1_000)
    assert 800 < drawn[0] < 1_200


def test_personal_data(docs, empty):
    rows = pii.find(docs, pii.train(docs)).collect()
    assert len(rows) == len(ROWS) and all(r.spans == "" for r in rows)
    assert pii.find(empty, pii.train(empty)).count() == 0


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted(out.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    kept = quality_rules.apply_policy(quality_rules.ledger(docs)).where("kept").select("doc_id", "text").collect()
    comp = _components([tuple(r) for r in kept], 5)
    kept = [r for r in kept if comp[r.doc_id][1] == r.doc_id]
    matcher = decontaminate.Matcher([tuple(r) for r in bench.select("item_id", "text").collect()])
    clean = {r.doc_id for r in kept if not list(matcher.search(decontaminate.normalise(r.text)))}
    chosen = mixing.plan(docs.where(F.col("doc_id").isin(list(clean)))).where("copies > 0")
    assert Counter(r.doc_id for r in rows) == {r.doc_id: r.copies for r in chosen.collect()}
