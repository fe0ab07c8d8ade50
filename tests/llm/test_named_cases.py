"""Cases that once went wrong: repeated ids, short items, clashing names, long runs."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from jornada.llm import decontaminate, mixing, near_dup, pii, quality_rules, token_store

ITEM = "the quick brown fox jumps over the lazy dog near the river bank"


def test_clean_judges_each_row_by_its_text(spark):
    rows = [(None, ITEM + " and more"), (None, "nothing of it"), (None, None), (1, ITEM), (1, "a clean text"), (2, "")]
    docs = spark.createDataFrame([(*r, 0, 1) for r in rows], "doc_id bigint, text string, dirty int, key int")
    items = spark.createDataFrame([(9, ITEM)], "item_id bigint, text string")
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(kept.select("doc_id", "text").collect(), key=str) == sorted(
        [r for r in rows if ITEM not in (r[1] or "")], key=str)


def test_short_items_are_found_as_whole_words(spark):
    docs = spark.createDataFrame(
        [(1, "He asked: What is 2 plus 2? Nobody knew."), (2, "what is 2 plus 25"), (3, "What is 2 plus 2"),
         (4, "somewhat is 2 plus 2"), (5, "two words"), (6, "a seen before thing"), (7, "word")],
        "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "What is 2 plus 2"), (2, "seen before"), (3, "word"), (4, "is 2 plus twenty one")],
                                  "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): (r.start, r.end) for r in decontaminate.matches(docs, items).collect()}
    assert set(found) == {(1, 1), (3, 1), (6, 2), (7, 3)}
    text = decontaminate.normalise("He asked: What is 2 plus 2? Nobody knew.")
    assert text[slice(*found[1, 1])] == "what is 2 plus 2"
    one_off = spark.createDataFrame([(1, "x is 2 plus twentj one y")], "doc_id bigint, text string")
    assert [r.distance for r in decontaminate.matches(one_off, items).collect()] == [1]


NAMES = ["n_words", "_n", "_c", "_size", "row_key", "dirty", "_t", "_words", "row", "size", "fail_bits", "component_id"]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, " ".join(f"word{j} number{j} other{j}" for j in range(30 + 9 * i)), "s", *[-7 - j for j in range(len(NAMES))]) for i in range(6)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, "
                                 + ", ".join(f"{n} int" for n in NAMES))


@pytest.mark.parametrize("stage", [quality_rules.keep, mixing.mix, near_dup.deduplicate, lambda d: decontaminate.clean(
    d, d.sparkSession.createDataFrame([(1, ITEM)], "item_id bigint, text string"))])
def test_stages_return_clashing_columns_untouched(clashing, stage):
    out = stage(clashing)
    assert out.columns == clashing.columns
    before = {r.doc_id: tuple(r) for r in clashing.collect()}
    after = out.collect()
    assert after and all(tuple(r) == before[r.doc_id] for r in after)


def test_ledger_replaces_only_its_own_names(clashing):
    row = quality_rules.ledger(clashing).where("doc_id = 0").first()
    assert row.n_words > 50 and row["_size"] == -10 and "_t" not in row.asDict()


def test_kept_is_the_component_id(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(7, text), (7, text + " more"), (9, text), (None, "lone row"), (3, None)],
                                 "doc_id bigint, text string")
    rows = near_dup.near_duplicates(docs).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in rows} == {
        (7, 7, True), (9, 7, False), (None, None, False), (3, 3, True)}


def test_added_tokens_are_those_of_the_library():
    from tokenizers import Tokenizer
    path = token_store.default_vocabulary()
    texts = ["hello <|endoftext|> there", "<|endoftext|>", "plain", "", "a<|endoftext|>b c"]
    plain = Tokenizer.from_file(path)
    assert [list(i) for i in token_store.PieceEncoder(path)(texts)] == [
        plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_rows_without_an_id_are_dealt_to_many_shards(spark, tmp_path):
    rows = [(None if i % 3 == 0 else i, f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        token_store.write_tokens(docs, str(tmp_path / "t"))
    finally:
        spark.conf.unset(name)
    shards = (token_store.open_store(spark, str(tmp_path / "t")).select("shard", F.explode("doc_ids").alias("d"))
              .where("d is null").groupBy("shard").count().collect())
    assert len(shards) >= 2 and sum(r["count"] for r in shards) == 1000


def plain_spans(text):
    out = []
    for kind, pattern in pii.PATTERNS.items():
        out += [(kind, *m.span()) for m in pattern.finditer(text) if pii._valid(kind, m.group())]
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(8)
    for alphabet in ("a1.@_-+% ", "1.2 ", "+1(). -9", "ab@.", "12.-+@x\u00e9 "):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
            assert pii.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text", ["7" * 1_000_000, "a" * 1_000_000 + " x@y.zz", "a" * 1_000_000 + "@",
                                  "1" * 500_000 + ".1.1", "1." * 400_000, "a@" * 300_000, "+1" + "(" * 900_000,
                                  "- " * 400_000, "a." * 400_000])
def test_base_spans_of_long_runs_are_linear(text):
    begun = time.process_time()
    pii.base_spans(text)
    assert time.process_time() - begun < 4


def test_short_form_patterns_are_fixed():
    assert re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)") == pii.PATTERNS["ip"]
