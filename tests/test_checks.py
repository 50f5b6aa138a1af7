"""Evidence, validation and publishing: one small case for each rule."""

import json

import pytest
from pyspark.sql import functions as F

from gazette.config import DEFAULT as CFG
from gazette.functions import signals as sg
from gazette.operators import validation
from gazette.sources import sinks

GOOD = "The secret password of the office was found by 12 clowns again."
LAW = "The released license of the public office keeps all rights reserved since 2024."
PAIRS = "array<struct<label:string,evidence:string>>"


def given(spark, raw, labels=()):
    df = spark.createDataFrame([(raw, list(labels))], "raw string, labels array<string>")
    return [tuple(x) for x in df.select(sg.given_pairs(F.col("raw"), F.col("labels")).alias("p")).first().p]


def test_three_forms_of_judged_signals(spark):
    pair = {"label": " Policy ", "evidence": " a  b "}
    both = {"detail": [pair, "x", {"label": "policy"}, {"evidence": "z"}], "signals": [{"label": "capex", "evidence": "c"}], "evidence": {"capex": "d"}}
    assert given(spark, json.dumps(both)) == [("policy", "a b")]
    assert given(spark, json.dumps(both | {"detail": []})) == [("capex", "c")]
    assert given(spark, json.dumps({"detail": ["x"], "signals": ["capex", "infra"], "evidence": {"capex": "d", "policy": "e"}})) == [("capex", "d")]
    assert given(spark, json.dumps({"signals": [], "evidence": {"policy": "e", "infra": 7}}), ["infra", "policy", "earnings"]) == [("infra", "7"), ("policy", "e")]
    assert given(spark, json.dumps({"signals": [pair, 5]})) == [("policy", "a b")]
    assert given(spark, "no json", ["policy"]) == given(spark, None) == given(spark, "[1]") == given(spark, '{"signals": "x", "evidence": [1]}') == []


def answers(spark, column, *rows):
    """The column's value for each (pairs, text), in one job."""
    df = spark.createDataFrame([(k, *row) for k, row in enumerate(rows)], f"k int, p {PAIRS}, t string")
    return [r.v for r in df.select("k", column.alias("v")).orderBy("k").collect()]


def plain(pairs):
    return [tuple(x) for x in pairs]


def test_labels_and_evidence_are_replaced(spark):
    text = f"{GOOD} {LAW}"
    cases = [
        ([("budget", GOOD)], text, [("security", GOOD)], ["relabelled"]),
        ([("security", "nowhere at all in this text, not once")], text, [("security", GOOD)], ["replaced_evidence"]),
        ([("security", "too short")], text, [("security", GOOD)], ["replaced_evidence"]),
        ([("earnings", GOOD)], text, [("security", GOOD)], ["relabelled"]),
        ([("budget", "this holds for no label at all here")], text, [], []),
        ([("budget", "too short")], text, [], []),
        # one pair a label, and one an evidence: the label that is exported first
        ([("market-demand", GOOD), ("security", GOOD.upper())], text, [("security", GOOD.upper())], []),
        ([("security", GOOD[:-1]), ("security", GOOD), ("policy", LAW)], text, [("security", GOOD), ("policy", LAW)], []),
        ([], "nothing here", [], []),
    ]
    got = answers(spark, sg.repaired(F.col("p"), F.col("t"), CFG), *((p, t) for p, t, *_ in cases), ([], text))
    assert [(plain(g.pairs), list(g.fixes)) for g in got[:-1]] == [(pairs, fixes) for *_, pairs, fixes in cases]
    assert got[-1].fixes == ["filled"] and ("security", GOOD) in plain(got[-1].pairs)


def test_sanitised_pairs_keep_the_best_of_each_label_then_each_evidence(spark):
    other = "A clown was seen by all of them."
    text = f"{GOOD} {other} {LAW}"
    got = answers(
        spark, sg.sanitized(F.col("p"), F.col("t"), CFG),
        ([("market-demand", other), ("security", GOOD), ("policy", LAW)], text),
        ([("market-demand", GOOD), ("market-demand", other), ("security", GOOD)], text),
        ([("policy", LAW.upper())], text), ([("policy", LAW)], ""), ([("policy", LAW)], None),
    )
    assert list(map(plain, got)) == [
        [("policy", LAW), ("security", GOOD), ("market-demand", other)],
        [("security", GOOD)],  # a label whose best evidence is taken goes, even if it has another
        [("policy", LAW.upper())], [], [],
    ]


def test_short_sentences_are_mined_with_a_neighbour(spark):
    texts = ["It was so. A secret. Then they all went home by train.", "Then they all went home by train. A secret.", "A secret.", "", None]
    got = answers(spark, sg.mined(F.col("t"), CFG), *(([], t) for t in texts))
    assert list(map(plain, got)) == [[("security", "A secret. Then they all went home by train.")], [("security", "Then they all went home by train. A secret.")], [], [], []]


BASE = {"item_id": 1, "title": "Alpha bravo charlie", "summary": "delta", "full_text": f"{GOOD} {LAW}", "dedupe_key": "alpha-bravo", "cluster_key": "alpha", "detail": [("security", GOOD)], "importance": 3, "quality": "ok", "outdated": False, "stale": False, "quality_reason": "", "why": "", "rationale": "", "malformed": False, "retry_detail": [], "retry_importance": 0}
TYPES = {"item_id": "long", "detail": PAIRS, "retry_detail": PAIRS, "importance": "int", "retry_importance": "int", "outdated": "boolean", "stale": "boolean", "malformed": "boolean"}


def test_what_becomes_of_each_kind_of_error(spark):
    cases = {
        "sound": ({}, {"action": "kept", "fixes": []}),
        # signals that are only missing lower the row; behind a trigger word they drop it, unless a second judgment has some
        "bare": ({"detail": [], "importance": 4, "full_text": "nothing", "summary": "delta"}, {"action": "kept", "importance": 2, "drop_reason": None}),
        "lost": ({"detail": [], "importance": 4, "title": "Alpha bravo license", "full_text": "nothing"}, {"action": "dropped", "drop_reason": "signals_missing", "quality": "low_quality", "quality_reason": "signals_missing"}),
        "again": ({"detail": [], "importance": 4, "title": "Alpha bravo license", "full_text": GOOD, "retry_detail": [("security", GOOD)], "retry_importance": 9}, {"action": "modified", "importance": 5, "fixes": ["filled", "second_judgment"]}),
        # low quality: 3 and more to 2, 2 to 1; excused rows stay
        **{f"low{n}": ({"quality": "low_quality", "importance": n}, {"importance": m, "quality_reason": CFG.quality_low_reason}) for n, m in ((5, 2), (3, 2), (2, 1), (1, 1))},
        "excused": ({"quality": "low_quality", "importance": 2, "quality_reason": "given"}, {"importance": 2, "errors_0": []}),
        "silent": ({"quality": "low_quality", "importance": 1, "why": CFG.why_missing, "rationale": CFG.rationale_low}, {"errors_0": []}),
        "old": ({"outdated": True}, {"drop_reason": "outdated"}), "incident": ({"outdated": True, "stale": True}, {"drop_reason": "stale_incident"}),
        "keys": ({"dedupe_key": "zzz-yyy", "cluster_key": "q/r"}, {"action": "modified", "fixes": ["new_keys"], "errors_1": []}),
        "cluster": ({"cluster_key": "q/r"}, {"errors_0": ["CLUSTER_MISALIGNED"]}),
        "hopeless": ({"title": "Alpha", "summary": "", "dedupe_key": "zzz-yyy"}, {"drop_reason": "validation_error", "fixes": ["new_keys", "signals_cleared"], "detail": []}),
        "format": ({"malformed": True}, {"errors_0": ["BAD_FORMAT"], "errors_1": []}),
        "twice": ({"detail": [("security", GOOD), ("market-demand", GOOD + "!")]}, {"errors_0": ["DUPLICATE_EVIDENCE", "EVIDENCE_REQUIRED"]}),
    }
    rows = [tuple((BASE | change | {"name": name}).values()) for name, (change, _) in cases.items()]
    df = spark.createDataFrame(rows, ", ".join(f"{k} {TYPES.get(k, 'string')}" for k in (*BASE, "name")))
    got = {r["name"]: r.asDict() for r in validation.handled(df, CFG).collect()}
    for name, (_, want) in cases.items():
        assert {k: got[name][k] for k in want} == want, name


def test_editions_lack_a_column(spark):
    rows = spark.createDataFrame([(k, "2024-01-01", f"k{k}", k) for k in range(6)], "item_id long, date string, dedupe_key string, pos int")
    assert [tuple(r) for r in validation.editions_valid(rows, CFG).collect()] == [("2024-01-01", 6, "MISSING_FIELD", False)]


def test_swapped_editions(spark, tmp_path):
    from gazette.plans.checks import SAYS

    path = f"{tmp_path}/e"
    schema = f"id string, date string, category string, title string, lines array<string>, why string, rationale string, detail {PAIRS}, dedupe_key string, source_name string, source_url string, published_at timestamp, status string, importance int, quality string, quality_reason string, pos int"
    import datetime

    def rows(date, n, title="Title"):
        at = datetime.datetime.fromisoformat(date)
        return [(str(k), date, "c", title, ["l"], "w", "r", [("security", SAYS[0])], f"k{k}", "s", "u", at, "kept", 3, "ok", "q", k) for k in range(n)]

    def publish(run, *editions):
        return sinks.swap_editions(spark.createDataFrame([r for e in editions for r in e], schema), path, run, {"note": F.lit(run)}, CFG)

    def current():
        return sorted((r.date, r.run, len(r["items"]), r.note) for r in sinks.read_editions(spark, path).collect())

    assert current() == []
    with pytest.raises(sinks.BrokenEdition):
        publish("zero", rows("2024-01-01", 21))  # nothing to keep
    assert publish("one", rows("2024-01-01", 6), rows("2024-01-02", 2)) == {}
    assert publish("two", rows("2024-01-01", 21), rows("2024-01-03", 5)) == {"2024-01-01": "TOO_MANY_ITEMS"}
    with pytest.raises(sinks.BrokenEdition):
        publish("three", rows("2024-01-02", 6), rows("2024-01-03", 6, title=""))
    assert current() == [("2024-01-01", "one", 6, "one"), ("2024-01-02", "one", 2, "one"), ("2024-01-03", "two", 5, "two")]
    publish("four", rows("2024-01-01", 7), rows("2024-01-02", 8))
    assert [x[1] for x in current()] == ["four", "four", "two"]


def test_outlets_that_look_like_patterns(spark):
    from gazette.functions import text as tx

    rows = [("The news - A.B (c)", "A.B (c)"), ("The news | \\Eback", "\\Eback"), ("The newsSRC0. ", "src0"), ("All src0 of it", "src0"), ("x", ""), ("y", None), ("src0", "src0")]
    df = spark.createDataFrame(rows, "t string, s string")
    assert [r.v for r in df.select(tx.strip_source(F.col("t"), F.col("s")).alias("v")).collect()] == ["The news", "The news", "The news", "All src0 of it", "x", "y", ""]


def test_tiers_take_normalised_names(spark):
    df = spark.createDataFrame([("SRC0 Daily",), ("src2news",), ("src2",), ("other",), (None,)], "s string")
    assert [r.v for r in df.select(sg.source_weight(F.col("s"), CFG).alias("v")).collect()] == [3.0, 1.5, 1.5, 0.3, 0.3]


def test_an_archive_that_is_not_there(spark, tmp_path):
    from gazette.sources import feeds

    found = feeds.digests(spark, f"{tmp_path}/none")
    assert feeds.last_edition(found).count() == 0 and feeds.archived(found).count() == 0


def test_feeds_in_two_formats_some_of_them_broken(spark, tmp_path):
    from gazette.operators import aggregates
    from gazette.sources import feeds

    def land(kind, **files):
        for feed, text in files.items():
            folder = tmp_path / kind / f"feed={feed}"
            folder.mkdir(parents=True)
            (folder / "part-0.txt").write_text(text)

    item = "<item><title>{} &amp; co</title><source url='u'> Out </source></item>"
    land("xml", sound=f"<rss><channel>{item.format('a')}{item.format('b')}</channel></rss>", cut=f"<rss><channel>{item.format('a')}<item><title>c", gone="<html>none", bare="<rss><channel><title>t</title></channel></rss>\n")
    land("json", lines='{"pos": 0, "title": "x", "source": {"title": "Out"}}\n{"pos": 1, "ti', torn='{"pos"')
    rows = feeds.union_feeds(feeds.landed_xml(spark, f"{tmp_path}/xml"), feeds.landed_json(spark, f"{tmp_path}/json"))
    found = sorted((r.feed_id, r.pos, r.title, r.source) for r in rows.where("NOT corrupt").select("feed_id", "pos", "title", "source").collect())
    assert found == [("cut", 0, "a & co", "Out"), ("lines", 0, "x", "Out"), ("sound", 0, "a & co", "Out"), ("sound", 1, "b & co", "Out")]
    health = {r.feed_id: (r.entries, r.state) for r in aggregates.feed_health(rows).collect()}
    assert health == {"cut": (1, "warning"), "lines": (1, "warning"), "sound": (2, "ok"), "gone": (0, "failure"), "torn": (0, "failure")}  # a whole feed without entries says nothing
