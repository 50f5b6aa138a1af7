"""Row-local work is done once for a row, whatever reads or filters it, and gives what it gave before."""

import re

import numpy as np
from pyspark.sql import functions as F

from gazette.config import DEFAULT as CFG
from gazette.functions import signals as sg
from gazette.functions import text as tx
from gazette.functions import tokens as tk
from gazette.llm.common import window_hashes
from gazette.operators import filters, output, validation
from gazette.plans.articles import derived, keyed, texts
from gazette.plans.queries import QUERIES, _published
from gazette.sources import feeds, sinks

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_text_is_lowered_once_though_filters_read_what_comes_of_it(spark):
    df = derived(spark, SF).where(F.col("reason").isNull() & (F.col("score") >= CFG.min_score)).select("item_id", "score", "longs")
    assert plan(df).count("lower(full_text") == 1


def test_a_key_is_made_once_though_filters_read_it(spark):
    df = keyed(spark, SF).where("dedupe_key <> 'news' AND cluster_key <> ''").select("item_id", "entities", "cluster_key")
    assert len(re.findall(r"split\(lower\(title", plan(df))) == 1


def test_what_nobody_reads_of_a_key_is_not_computed(spark):
    whole = keyed(spark, SF)
    few = keyed(spark, SF, only=("cluster_key",))
    assert {"reason", "numbers", "entities", "events", "action", "key_prefix"} == {*whole.columns} - {*few.columns}
    names = ["id", "rank", "title", "dedupe_key", "cluster_key"]
    assert sorted(map(tuple, few.select(names).collect())) == sorted(map(tuple, whole.select(names).collect()))
    for name in ("key_prefixes", "quality_gates", "cluster_duplicates", "recent_duplicates"):
        assert not re.search("hard_exclude_keyword", plan(QUERIES[name](spark, SF)))


def test_endings_go_as_by_the_pattern(spark):
    words = ["nationing", "eding", "ingment", "esesesesxes", "es", "aes", "abes", "tion", "xtion", "xytion", "licence", "ing", "theing", "가나ed", "q", "abcdmented"]
    ending = "^(.{2,}?)(?:" + "|".join(sorted(CFG.endings, key=len, reverse=True)) + ")$"
    old = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in CFG.aliases for x in pair]), F.col("w")), F.col("w"))
    for _ in range(3):
        old = F.regexp_replace(old, ending, "$1")
    long_enough = F.length(old) >= F.when(old.rlike("[가-힣]"), 2).otherwise(3)
    rows = spark.createDataFrame([(w,) for w in words], "w string").select(tk.normal_token(F.col("w"), CFG).alias("new"), F.when(old.isin(*CFG.stopwords) | ~long_enough, "").otherwise(old).alias("old")).collect()
    assert [r["new"] for r in rows] == [r["old"] for r in rows]


def test_too_short_counts_words_as_splitting_does(spark):
    texts = ["", "one two three four five six", "one  two\tthree\nfour five sixes", "  one two three four five and", "one two three four fivefivefive", "a" * 50, "a b c d e f g h i j k l m n", " " * 30, "x" * 30 + " a b c d", "x" * 30 + " a b c d e"]
    old = (F.length("t") < 20) | (F.size(F.filter(F.split(F.trim("t"), r"\s+"), lambda x: x != "")) < 6)
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(sg.too_short(F.col("t")).alias("new"), old.alias("old")).collect()
    assert [r["new"] for r in rows] == [r["old"] for r in rows]


def test_byte_windows_are_equal_where_their_hashes_are():
    rng = np.random.default_rng(3)
    for k in (5, 8, 13, 16, 20, 24):
        body = rng.integers(97, 99, 3000).astype(np.uint8)
        h = window_hashes(body, k)
        windows = [body[i : i + k].tobytes() for i in range(len(body) - k + 1)]
        assert len(h) == len(windows)
        assert len(set(zip(windows, h.tolist()))) == len(set(windows)) == len(set(h.tolist()))


def test_text_work_comes_before_the_join_and_each_keyword_is_looked_up_once(spark):
    said = plan(derived(spark, SF))
    for word in ("license", "apache", "version", "scum"):
        assert len(re.findall(rf"Contains\(low#\d+, {word}\)", said)) == 1
    published = plan(output.output_rows(_published(spark, SF), CFG))
    assert published.count("Relation [doc_id") == 2  # documents and labels, each read once
    above, below = published.split("Join Inner")  # with events
    assert "full_text" not in above and "low#" not in above and "Contains(low#" in below


def test_looked_up_keywords_say_what_the_text_says(spark):
    low = tx.Lowered(tx.lowered(F.col("full_text")))
    labels = sg.impact_signals(low, CFG)
    plain = derived(spark, SF).withColumns({"signals_2": labels, "longs_2": sg.long_labels(low, labels, CFG), "reason_2": filters.skip_reason(low, F.col("link"), F.lit(None).cast("string"), labels, F.col("age"), F.col("category"), CFG)})
    assert plain.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert plain.where("NOT (signals <=> signals_2 AND longs <=> longs_2 AND reason <=> reason_2)").count() == 0
    assert derived(spark, SF, reasons=False).join(plain.select("item_id", "signals_2", "longs_2"), "item_id").where("NOT (signals <=> signals_2 AND longs <=> longs_2)").count() == 0


def test_title_and_summary_are_the_first_two_lines(spark, tmp_path):
    said = [None, "", "a", "a\n", "\n", "\nb", "\n\nb", "a\n\nc", "a\nb", "a\nb\n", "a\nb\nc\nd", "é\r\nü\nß"]
    spark.createDataFrame(list(enumerate(said)), "doc_id long, text string").selectExpr("*", "'src0' AS source", "'en' AS lang", "0L AS n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["item_id"]: (r["title"], r["summary"], r["full_text"]) for r in texts(spark, str(tmp_path)).collect()}
    lines = [(t or "").split("\n") for t in said]
    assert got == {i: (x[0], x[1] if len(x) > 1 else "", said[i] or "") for i, x in enumerate(lines)}


def test_rows_that_do_not_count_all_go_out_beside_the_first_of_a_key(spark):
    rows = [(1, "k", None), (2, " k ", None), (3, "K", None), (4, "", None), (5, None, None), (6, "k", "merged"), (6, "k", "merged"), (7, "k", "dropped"), (8, "z", "published")]
    df = spark.createDataFrame(rows, "item_id long, dedupe_key string, status string").selectExpr(
        "'2024-01-01' AS date", "1.0D AS pick_rank", "*", "'t' AS title", "array('l') AS lines", "'' AS resolved_url", "'u' AS link", "TIMESTAMP '2024-01-01' AS published_at", "TIMESTAMP '2024-01-01' AS updated_at", "'s' AS source", "'c' AS category",
        "'' AS why", "'' AS rationale", "array(named_struct('label', 'policy', 'evidence', '')) AS detail", "array('policy') AS longs", "3 AS importance", "'ok' AS quality", "'' AS quality_reason", "'' AS cluster_key", "CAST(NULL AS string) AS drop_reason",
    )
    out = output.output_rows(df, CFG)
    assert sorted(r["item_id"] for r in out.collect()) == [1, 3, 4, 5, 6, 6, 8]
    assert plan(out).count("Union") == 0


def test_an_edition_key_is_made_once_for_a_row(spark):
    rows = [("d", 1, "a  b", None), ("d", 2, "a b", "X"), ("d", 3, "", "Y"), ("e", 1, "c", None), ("e", 2, None, "Z"), ("e", 3, "e", "W")]
    verdict = validation.digest_valid(spark.createDataFrame(rows, "date string, pos int, dedupe_key string, code string"), CFG, 3)
    assert {r["date"]: (r["n_items"], r["code"], r["valid"]) for r in verdict.collect()} == {"d": (3, "DUPLICATE_KEY", False), "e": (3, "Z", False)}
    physical = verdict._jdf.queryExecution().sparkPlan().toString()
    assert not [line for line in physical.splitlines() if "Aggregate" in line and "regexp_replace" in line]


def test_a_large_edition_is_several_documents_and_loses_nothing(spark, tmp_path):
    rows = spark.range(25).selectExpr("IF(id < 23, '2024-01-02', '2024-01-01') AS date", "CAST(id AS int) AS pick_rank", "CAST(id AS string) AS id", "'c' AS category", "'t' AS title", "'k' AS dedupe_key", "'' AS cluster_key", "IF(id = 0, 'merged', 'kept') AS status", "1 AS importance", "'s' AS source_name")
    sinks.write_snapshots(rows, f"{tmp_path}/a", most=10)
    found = feeds.digests(spark, f"{tmp_path}/a")
    assert sorted((r["snapshot"], r["n"]) for r in found.selectExpr("snapshot", "size(items) AS n").collect()) == [("2024-01-01", 2), ("2024-01-02", 3), ("2024-01-02", 10), ("2024-01-02", 10)]
    assert {r["snapshot"]: r["n"] for r in feeds.archived(found).collect()} == {"2024-01-01": 2, "2024-01-02": 22}
    assert sorted(int(r["id"]) for r in feeds.last_edition(found).collect()) == list(range(23))
    # a date that is written again has what it has now; the other stays
    sinks.write_snapshots(rows.where("pick_rank < 3"), f"{tmp_path}/a", most=10)
    assert {r["snapshot"]: r["n"] for r in feeds.archived(feeds.digests(spark, f"{tmp_path}/a")).collect()} == {"2024-01-01": 2, "2024-01-02": 2}
