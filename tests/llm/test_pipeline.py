from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from corpus_pipeline import ORACLE_SQL, STAGES, run
from ledgerloom.llm.catalog import QUERIES, SQL
from tests.llm.oracle import compare
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_ngram_jaccard import brute as linked
from tests.llm.test_token_files import plain

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
RULES = {"de": "der und schung keit", "en": "the and ing tion", "es": "los que cion ado", "fr": "les aux ment eau"}


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    rng = random.Random(8)
    rows = []
    for key in range(160):
        language = rng.choice(sorted(RULES))
        words = ["".join(rng.choices(RULES[language].split(), k=2)) for _ in range(rng.randint(30, 60))]
        rows.append((key, " ".join(words), language, f"s{key % 3 if key % 2 else 0}"))
    exact = [(200 + i, rows[i][1], rows[i][2], "s1") for i in range(10)]
    item = " ".join(f"bench{i}" for i in range(15))
    leaks = [(300 + i, rows[20 + i][1] + " " + item, rows[20 + i][2], "s2") for i in range(5)]
    junk = [(400, None, "en", "s0"), (401, "", "en", "s0"), (402, "12 !! 34", "de", None)]
    path = tmp_path_factory.mktemp("sf")
    docs(rows + exact + leaks + junk).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = []
    for _, stage in STAGES:
        docs = stage(spark, docs, folder).cache()
        out.append(docs.collect())
    first, second, third, fourth, last = out
    source = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert {r.doc_id for r in first} == {r.doc_id for r in source} - {400, 401, 402}
    stays = {key for key, _, component in linked([(r.doc_id, r.text) for r in first]) if key == component}
    assert {r.doc_id for r in second} == stays and not stays & set(range(200, 210))
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hit = {r[0] for r in contaminated([(r.doc_id, r.text) for r in second], bench, 10) if r[-1]}
    assert {r.doc_id for r in third} == {r.doc_id for r in second} - hit and hit == set(range(300, 305))
    assert {r.doc_id for r in fourth} == {r.doc_id for r in third} and len(fourth) > len(third)
    for rows in (first, second, third, fourth):
        assert list(rows[0].asDict()) == COLUMNS
    start, expected = 0, []
    for r in sorted(fourth, key=lambda r: r.doc_id):
        ids = np.array(plain([r.text])[0], "<u4")
        expected.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, last)) == expected


def test_run_and_registration(spark, folder):
    assert ORACLE_SQL is None
    assert run(spark, folder).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in QUERIES if q.startswith("op")}


def test_near_duplicate_stage_with_repeated_rows(spark, docs, folder):
    rows = docs([(5, "a b c"), (5, "a b c"), (6, "a b c"), (None, "a b c"), (9, None)])
    got = sorted((r.doc_id or -1 for r in STAGES[1][1](spark, rows, folder).collect()))
    assert got == [-1, 5, 9]


def test_near_duplicate_stage_takes_five_words_and_eighty_percent(spark, docs, folder):
    words = [f"w{i}" for i in range(200)]
    near, far, apart = words.copy(), words.copy(), words.copy()
    for i in (30, 90, 150):  # 181 of 211 shingles of five words, 0.858; of three words, 189 of 207
        near[i] = "new"
    for i in (20, 60, 100, 140):  # 176 of 216, 0.815; of three words 186 of 210, 0.886
        far[i] = f"other{i}"
    for i in range(10, 190, 20):  # 151 of 241, 0.627
        apart[i] = f"third{i}"
    rows = docs([(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(apart))])
    assert sorted(r.doc_id for r in STAGES[1][1](spark, rows, folder).collect()) == [1, 4]


def test_contaminated_documents_without_an_id_go(spark, docs, folder):
    item = " ".join(f"bench{i}" for i in range(15))
    rows = docs([(None, f"some words {item} more"), (None, "clean words"), (7, f"x {item}"), (7, "clean too"), (8, None), (None, None)])
    got = sorted((repr(r.doc_id), r.text) for r in STAGES[2][1](spark, rows, folder).collect() if r.text)
    assert got == [("7", "clean too"), ("None", "clean words")]
    assert STAGES[2][1](spark, rows, folder).count() == 4


def test_stages_keep_clashing_columns_and_long_texts(spark, folder):
    """Extra columns named like those that stages make for themselves stay as they are."""
    extra = ["id", "mark", "_mark", "component_id", "pass", "g", "b", "t", "place", "doc", "accepted", "contaminated", "n"]
    long = " ".join(f"the{i % 977} and{i % 983} ing{i % 991}" for i in range(20_000))
    rows = [(1, long, "en", "s"), (2, "the and of the ing and tion the", "en", "s"), (3, "the words and the tion of them and", "en", None)]
    plain = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = plain
    for i, c in enumerate(extra):
        docs = docs.withColumn(c, plain.doc_id * 100 + i)
    for name, stage in STAGES:
        out = stage(spark, docs, folder)
        if name != "tokens":
            assert out.columns == docs.columns
            assert all(r[c] == r.doc_id * 100 + i for r in out.collect() for i, c in enumerate(extra))
        assert out.select("doc_id").distinct().count() == stage(spark, plain, folder).select("doc_id").distinct().count()


def test_stages_on_an_empty_table(spark, docs, folder):
    for _, stage in STAGES:
        assert stage(spark, docs([(1, "a")]).limit(0), folder).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_beside_their_sql(spark, small, name):
    assert ": same " in compare(spark, small, name)
