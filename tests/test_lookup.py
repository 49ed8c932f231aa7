import pytest

from codeloom.plans import lookup as L
from codeloom.session import new_table_path
from codeloom.sources.catalog import synthetic_catalog
from codeloom.sources.prefixes import PrefixLayout, covered, read_prefix_table, write_prefix_table
from codeloom.sources.tables import code_filter, full_mapping


def ask(spark, mapping, text, limit=1000):
    queries = spark.createDataFrame([(1, text)], "query_id int, query string")
    summary, rows = L.by_prefix(queries, mapping, limit)
    return summary.first(), [r.product_id for r in rows.orderBy("rank").collect()]


def test_lookup(spark, mapping):
    ids = spark.createDataFrame([("0",), ("7",), ("-1",), ("not-an-int",), ("7",), (None,)], "product_id string")
    got = {r.product_id: r for r in L.lookup(ids, mapping).collect()}
    assert set(got) == {0, 7}
    assert (got[0].code_id, got[0].bucket_size, got[0].brand) == ("1-4-2-0", 2, "Alpha")
    assert got[7].bucket_size == 3


def test_lookup_takes_numbers_as_they_are(spark, mapping):
    assert L.lookup(spark.createDataFrame([(3.9,)], "product_id double"), mapping).first().product_id == 3


@pytest.mark.parametrize(
    "text,ids",
    [("1", [0, 1, 2, 3]), ("1-4", [0, 1, 2]), ("1, 4", [0, 1, 2]), ("1 4", [0, 1, 2]), ("1/4", [0, 1, 2]),
     ("1-4-2", [0, 1]), ("1-4-2-1", [1]), (" 11 ", [4]), ("-1", [0, 1, 2, 3]), ("+1", [0, 1, 2, 3]), ("1_1", [4]),
     ("77", []), ("99999999999999999999", []), ("1-4-2-9", [])],
)
def test_prefix(spark, mapping, text, ids):
    summary, got = ask(spark, mapping, text)
    assert got == ids and summary.error is None and summary.total_count == len(ids) and not summary.truncated


def test_prefix_levels_and_exactness(spark, mapping):
    assert ask(spark, mapping, "1-4-2-1")[0].is_exact
    summary, _ = ask(spark, mapping, "1-4")
    assert (summary.matched_levels, summary.is_exact) == (2, False)


@pytest.mark.parametrize("text", ["1-4-2-1-1", "abc", "1-x", "", "   ", "--"])
def test_prefix_errors_are_values(spark, mapping, text):
    summary, got = ask(spark, mapping, text)
    assert summary.error and got == [] and summary.matched_levels == 0 and summary.total_count == 0


def test_error_texts(spark, mapping):
    assert ask(spark, mapping, "")[0].error == "Query is empty."
    assert ask(spark, mapping, "1-x")[0].error == "'x' is not an integer token."
    assert ask(spark, mapping, "1-4-2-1-1")[0].error == "Too many tokens (5); expected at most 4 (c1..c3 + dedup)."


def test_prefix_limit_reports_the_total(spark, mapping):
    summary, got = ask(spark, mapping, "1", limit=2)
    assert (summary.total_count, summary.truncated, got) == (4, True, [0, 1])


def test_equal_queries_get_equal_answers(spark, mapping):
    queries = spark.createDataFrame([(1, "1-4"), (2, "1 4"), (3, "6")], "query_id int, query string")
    summary, rows = L.by_prefix(queries, mapping)
    assert {r.query_id: r.total_count for r in summary.collect()} == {1: 3, 2: 3, 3: 3}
    assert rows.count() == 9
    assert {r.brand for r in rows.where("query_id = 1").collect()} == {"Alpha", "Beta"}


@pytest.fixture(scope="module")
def stored(spark, mapping):
    path = new_table_path(spark, "prefixes")
    write_prefix_table(mapping.repartition(3), path)
    return read_prefix_table(spark, path)


@pytest.mark.parametrize("text", ["1", "1-4", "1-4-2", "1-4-2-1", "11", "8-0-5-0", "77", "99999999999999999999", "16", "6-2-2-9", "x"])
def test_stored_ranges_answer_alike(spark, mapping, stored, text):
    rows, layout = stored
    queries = spark.createDataFrame([(1, text), (2, "5")], "query_id int, query string")
    for plain, ranged in zip(L.by_prefix(queries, mapping, 2), L.by_prefix(queries, rows, 2, layout=layout)):
        assert plain.columns == ranged.columns
        assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, ranged.collect()), key=repr)


def test_one_pruned_scan(spark, stored, capsys):
    rows, layout = stored
    queries = spark.createDataFrame([(1, "1-4"), (2, "6"), (3, "8-0-5-1")], "query_id int, query string")
    for answer in L.by_prefix(queries, rows, 5, layout=layout):
        answer.explain("formatted")
        plan = capsys.readouterr().out
        scans = [part for part in plan.split("\n\n") if "Scan parquet" in part and "ReadSchema" in part]
        assert len(scans) == 1 and "GreaterThanOrEqual(prefix_key" in scans[0] and "LessThanOrEqual(prefix_key" in scans[0]


def test_keys_keep_the_order_of_the_codes(spark, stored):
    rows, layout = stored
    assert layout.bits == (4, 3, 4, 2)
    by_key = [tuple(r) for r in rows.orderBy("prefix_key").select("c1", "c2", "c3", "dedup").collect()]
    assert by_key == sorted(by_key)
    with pytest.raises(ValueError, match="63"):
        PrefixLayout((32, 32))
    with pytest.raises(ValueError, match="negative"):
        write_prefix_table(spark.createDataFrame([(1, -1, 0)], "product_id long, c1 int, dedup int"), "unused")


def test_cover_of_intervals():
    assert covered([], 3) == []
    assert covered([(5, 6), (1, 2), (3, 3), (10, 10)], 5) == [(1, 3), (5, 6), (10, 10)]
    assert covered([(1, 1), (3, 3), (10, 10), (30, 40), (35, 50)], 2) == [(1, 10), (30, 50)]
    assert covered([(1, 1), (100, 100)], 1) == [(1, 100)]


def test_tuple_mates(spark, mapping):
    asked = spark.createDataFrame([(8,), (4,)], "product_id long")
    for limit, want in ((None, {8: {7, 8, 9}, 4: {4}}), (2, {8: {7, 8}, 4: {4}})):
        got = {}
        for r in L.tuple_mates(asked, mapping, limit).collect():
            got.setdefault(r.query_id, set()).add(r.product_id)
            assert r.total_count == {8: 3, 4: 1}[r.query_id] and r.truncated == (limit == 2 and r.query_id == 8)
        assert got == want


@pytest.fixture(scope="module")
def vectors(spark):
    catalog = synthetic_catalog(spark, 10, 2, 1, 2, seed=7, dim=16)
    return catalog.select("product_id", "content_embedding")


def pair(spark, mapping, a, b, vectors=None):
    pairs = spark.createDataFrame([(a, b)], "product_id_a long, product_id_b long")
    return L.compare(pairs, mapping, vectors).first()


def test_compare_same_product(spark, mapping, vectors):
    r = pair(spark, mapping, 0, 0, vectors)
    assert r.cosine_similarity == pytest.approx(1, abs=1e-5)
    assert r.shared_prefix_depth == 3 and r.same_code_tuple and r.same_code_id
    assert all(r[f"{f}_match"] for f in ("league", "team", "brand", "color", "price_band", "is_hot_market"))


def test_compare_tuple_mates_and_flag_case(spark, mapping, vectors):
    r = pair(spark, mapping, 0, 1, vectors)
    assert r.same_code_tuple and not r.same_code_id and r.is_hot_market_match


def test_compare_different_products(spark, mapping, vectors):
    r = pair(spark, mapping, 0, 2, vectors)
    assert r.shared_prefix_depth == 2 and not r.brand_match and not r.is_hot_market_match and r.team_match
    v = {x.product_id: x.content_embedding for x in vectors.collect()}
    direct = sum(x * y for x, y in zip(v[0], v[2]))
    assert r.cosine_similarity == pytest.approx(direct, abs=1e-4)
    assert pair(spark, mapping, 0, 4, vectors).shared_prefix_depth == 0


def test_compare_without_vectors(spark, mapping, vectors):
    r = pair(spark, mapping, 999, 0, vectors)
    assert r.error is None and r.cosine_similarity is None and "999" in r.cosine_unavailable_reason
    r = pair(spark, mapping, 0, 1)
    assert r.cosine_similarity is None and r.cosine_unavailable_reason == "Embedding index not built."


def test_compare_unknown_product(spark, mapping, vectors):
    r = pair(spark, mapping, -1, 0, vectors)
    assert r.error == "product_id(s) not found: -1" and r.shared_prefix_depth == 0 and r.league_match is None


def test_agreement_long(spark, mapping):
    pairs = spark.createDataFrame([(0, 2), (-1, 0)], "product_id_a long, product_id_b long")
    rows = {r.field: r for r in L.agreement_long(L.compare(pairs, mapping)).collect()}
    assert len(rows) == 6 and not rows["brand"].match and rows["brand"].value_a == "Alpha"


def test_full_mapping_keeps_products_without_metadata(spark, mapping):
    codes = mapping.select("product_id", "c1", "c2", "c3", "dedup")
    source = mapping.where("product_id <> 999").drop("c1", "c2", "c3", "dedup", "code_id")
    rows = {r.product_id: r for r in full_mapping(codes, source).collect()}
    assert len(rows) == 11 and rows[999].league is None and rows[999].code_id == "0-0-9-0"


def test_code_filter_reaches_the_scan(spark, mapping, tmp_path):
    path = str(tmp_path / "m")
    mapping.write.parquet(path)
    stored = spark.read.parquet(path).where(code_filter(["c1", "c2", "c3"], [1, 4]))
    assert stored.count() == 3
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c1,1)" in plan and "EqualTo(c2,4)" in plan
    with pytest.raises(ValueError):
        code_filter(["c1"], [1, 2, 3])
