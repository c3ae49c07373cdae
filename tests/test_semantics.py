"""Edge cases of the semantics decided on purpose (one per quirk in SURVEY §2.12/§5)."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.functions.cdc import date_to_epoch_us
from tessera.functions.columns import percent_half_up
from tessera.operators import groups, joins, pii, predicates, quality, ranges, text, windows
from tessera.operators.graph import reachable
from tessera.operators.reports import fiscal_code_valid, vat_valid


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_like_wildcard_vs_escaped(spark):
    df = spark.createDataFrame([(1, "ACA_1"), (2, "ACAX2"), (3, None), (4, "GPD-4")], "id int, iupd string")
    wild = predicates.prefix_filter(df, "iupd", "ACA_", negate=True)
    esc = predicates.prefix_filter(df, "iupd", "ACA_", negate=True, escaped=True)
    assert rows(wild, "id") == [(4,)]            # '_' matches X; NULL dropped by NOT LIKE
    assert rows(esc, "id") == [(2,), (4,)]


def test_percent_half_up_exact_on_edges(spark):
    df = spark.createDataFrame([(1, 200), (1, 800), (0, 0), (2, 3), (3, 4000)], "f long, s long")
    got = [r[0] for r in df.select(percent_half_up("f", "s")).collect()]
    assert got == [0.5, 0.13, None, 66.67, 0.08]  # 0.125 → 0.13 and 0.075 → 0.08 (half up); 0/0 → null


def test_kpi_outcome_nulls_are_ko(spark):
    df = spark.createDataFrame([(1.0, None), (None, 5.0), (5.0, 5.0), (6.0, 5.0)], "p double, t double")
    got = [r[0] for r in predicates.with_outcome(df, "p", "t", "o").select("o").collect()]
    assert got == ["KO", "KO", "OK", "KO"]


def test_group_mapping_duplicates_and_shared_members(spark):
    crm = spark.createDataFrame([("C1", "A, B"), ("C2", "B,C"), ("C3", "D,D"), ("C4", " E "), ("C5", " , ")],
                                "contract_id string, provider_names string")
    m = {r.psp_member: (r.group_key, r.contract_id) for r in groups.group_mapping(crm).collect()}
    assert m["B"] == ("A,B", "C1")               # member of two groups → smallest group key
    assert m["D"] == ("D,D", "C3")               # duplicate inside one list still makes size 2
    assert "E" not in m                          # group of one dropped
    mc = {r.psp_member: r.contract_id for r in groups.member_contract(crm).collect()}
    assert mc["E"] == "C4" and mc["B"] == "C1"


def test_length_bins_keep_the_gaps(spark):
    df = spark.createDataFrame([("x" * n,) for n in (0, 1, 2, 30, 31, 32, 141, 142)] + [(None,)], "d string")
    rep = {r.bucket: r.n for r in quality.length_histogram(df, "d").collect()}
    assert rep["> 1 e <= 30 car."] == 2           # 2 and 30; lengths 0, 1 and 31 fall in no bin
    assert rep["> 30 e <= 50 car."] == 1          # 32 only
    assert rep["> 140 car."] == 1                 # 142 only
    closed = {r.bucket: r.n for r in quality.length_histogram(df, "d", contiguous=True).collect()}
    assert sum(closed.values()) == 7              # every non-empty text binned


def test_horizon_presets_edges(spark):
    as_of = predicates.epoch_micros("2020-01-01 00:00:00")
    year = 365 * 86400 * 1_000_000
    df = spark.createDataFrame([(as_of - year,), (as_of,), (as_of + year,), (as_of + 40 * year,), (None,)],
                               "due_date long")
    h4 = {r.bucket: r.n for r in quality.horizon_clusters(df, "due_date", as_of, "h4").collect()}
    h6 = {r.bucket: r.n for r in quality.horizon_clusters(df, "due_date", as_of, "h6").collect()}
    v6 = {r.bucket: r.n for r in quality.horizon_clusters(df, "due_date", as_of, "h6_vec").collect()}
    assert h4["Entro 10 anni"] == 3               # past and today included
    assert h6["Entro 1 anno"] == 1                # (0, 1]: exactly one year in, past/today out
    assert v6["Entro 1 anno"] == 2 and v6["Tra 1 e 2 anni"] == 1   # [0, 1): one year moves up
    assert h4["Oltre 30 anni"] == h6["Oltre 30 anni"] == v6["Oltre 30 anni"] == 1
    far = spark.createDataFrame([(as_of + 400 * year,)], "due_date long")
    limit = quality.PANDAS_SECONDS_LIMIT            # the source's pandas range, on request only
    assert sum(r.n for r in quality.horizon_clusters(far, "due_date", as_of, "h6_vec").collect()) == 1
    assert sum(r.n for r in quality.horizon_clusters(far, "due_date", as_of, "h6_vec", limit).collect()) == 0


def test_top_k_ties_are_deterministic(spark):
    df = spark.createDataFrame([("p", "b", 5), ("p", "a", 5), ("p", "c", 5)], "g string, k string, v int")
    top = windows.top_k_per_group(df, ["g"], [F.desc("v"), F.asc("k")], 2)
    assert rows(top, "k") == [("a",), ("b",)]


def test_reconcile_empty_side_reports_nothing(spark):
    a = spark.createDataFrame([("t1", "n1", 1), ("t1", "n9", 2)], "tok string, n string, seq int")
    empty = a.limit(0)
    only_a, only_b = joins.reconcile(a, empty, "tok", "tok", "seq", "seq")
    assert only_a.count() == 0 and only_b.count() == 0
    only_a, _ = joins.reconcile(a, empty, "tok", "tok", "seq", "seq", empty_guard=False)
    assert rows(only_a, "tok", "n") == [("t1", "n9")]       # last row wins
    same_a, same_b = joins.reconcile(a, a, "tok", "tok", "seq", "seq")
    assert same_a.count() == 0 and same_b.count() == 0      # reconcile(a, a) = ∅


def test_adjacent_overlap_misses_contained_range(spark):
    df = spark.createDataFrame([(1, "X", 0, 100), (2, "X", 10, 20), (3, "X", 30, 40)],
                               "row_key int, abi string, low_range int, high_range int")
    df = df.select("row_key", "abi", *[F.col(c).cast("decimal(38,0)").alias(c) for c in ("low_range", "high_range")])
    pairs = rows(ranges.overlap_adjacent(df), "a_key", "b_key")
    assert pairs == [(1, 2)]                     # (1, 3) overlaps too but is not adjacent


def test_adjacent_overlap_bucketed_equals_single_window(spark):
    rnd = random.Random(11)
    data = [(k, "HOT" if k % 3 else f"A{k % 5}", lo, lo + rnd.choice([3, 30, 300]))
            for k, lo in enumerate(rnd.randrange(0, 20_000) for _ in range(600))]
    df = spark.createDataFrame(data, "row_key int, abi string, low_range long, high_range long")
    got = rows(ranges.overlap_adjacent(df, rows_per_bucket=25), "abi", "a_key", "b_key")
    want = []
    for owner in {d[1] for d in data}:
        srt = sorted((d for d in data if d[1] == owner), key=lambda d: (d[2], d[0]))
        want += [(owner, a[0], b[0]) for a, b in zip(srt, srt[1:]) if a[3] >= b[2]]
    assert got == sorted(want)


def test_cross_overlap_matches_brute_force_with_wide_ranges(spark):
    rnd = random.Random(7)
    data = []
    for k in range(300):
        lo = rnd.randrange(0, 10**6)
        width = rnd.choice([5, 50, 500, 200_000])     # a few very wide ranges
        data.append((k, f"A{rnd.randrange(4)}", lo, lo + width))
    df = spark.createDataFrame(data, "row_key int, abi string, low_range long, high_range long").select(
        "row_key", "abi", F.col("low_range").cast("decimal(38,0)").alias("low_range"),
        F.col("high_range").cast("decimal(38,0)").alias("high_range"))
    got = rows(ranges.overlap_cross(df, fanout=4), "a_key", "b_key")
    want = sorted((a[0], b[0]) for a in data for b in data
                  if a[1] != b[1] and a[2] <= b[2] <= a[3] and (a[2], a[0]) < (b[2], b[0]))
    assert got == want


def test_epoch_text_clamps_year(spark):
    df = spark.createDataFrame([("12000-01-02T00:00:00",), ("2020-01-02T00:00:00",), (None,)], "d string")
    got = [r[0] for r in df.select(date_to_epoch_us(F.col("d"), True)).collect()]
    assert got[0] == predicates.epoch_micros("9999-01-02 00:00:00")
    assert got[1] == predicates.epoch_micros("2020-01-02 00:00:00") and got[2] is None
    compat = df.select(date_to_epoch_us(F.lit("2020-01-02 00:00:00.5"), True, compat=True)).first()[0]
    assert compat == predicates.epoch_micros("2020-01-02 00:00:00") + 1_000_000


def test_tax_code_checksums(spark):
    df = spark.createDataFrame([("RSSMRA80A01H501U",), ("RSSMRA80A01H501X",), ("12345678903",), ("12345678900",)],
                               "c string")
    got = [(r[0], r[1]) for r in df.select(fiscal_code_valid(F.col("c")), vat_valid(F.col("c"))).collect()]
    assert got == [(True, False), (False, False), (False, True), (False, False)]


def test_redaction_validates_checksums(spark):
    df = spark.createDataFrame([("card 4785380592391139 bad 4785380592391138 cf RSSMRA80A01H501U plate AB123CD "
                                 "mail a.b@x.org",)], "t string")
    out = pii.redact(df, "t").first()[0]
    assert "<CREDIT_CARD>" in out and "4785380592391138" in out
    assert "<IT_FISCAL_CODE>" in out and "<IT_VEHICLE_PLATE>" in out and "<EMAIL_ADDRESS>" in out
    masked = pii.redact(df, "t", mode="mask").first()[0]
    assert "RSSMRA**********" in masked and "AB123**" in masked


def test_page_text_prefers_main_and_drops_chrome(spark):
    html = ("<html><body><nav>menu</nav><header>top</header><main><p>Hello</p><script>x()</script>"
            "<p>world &amp; more text to pass the minimum length of fifty characters</p></main>"
            "<footer>bottom</footer></body></html>")
    df = spark.createDataFrame([("u", html), ("v", "<html><body><p>short</p></body></html>")], "url string, html string")
    out = {r.url: r.text for r in text.page_text(df).collect()}
    assert out == {"u": "Hello\nworld & more text to pass the minimum length of fifty characters"}


def test_split_spans_cover_text_with_bounded_overlap():
    rnd = random.Random(3)
    words = ["alpha", "beta", "gamma\n", "delta\n\n", "eps"]
    txt = " ".join(rnd.choice(words) for _ in range(2000))
    spans = text.split_spans(txt, 300, 60)
    assert spans[0][0] == 0 and spans[-1][1] == len(txt)
    for (a0, a1), (b0, b1) in zip(spans, spans[1:]):
        assert a1 - a0 <= 300 and b0 <= a1 and a1 - b0 <= 60 and b0 > a0


def test_reachable_follows_multiple_hops(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("d", "b")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "node string")
    assert rows(reachable(edges, seeds), "node") == [("a",), ("b",), ("c",), ("d",)]


def test_day_range_and_previous_month():
    today = dt.date(2024, 3, 15)
    assert predicates.previous_month(today) == ("2024-02-01T00:00:00Z", "2024-03-01T00:00:00Z")
    assert predicates.day_range("yesterday", "bad", today) == (dt.date(2024, 3, 14), dt.date(2024, 3, 15))
    assert predicates.day_range("all", None, today) is None


def test_emit_events_to_files(spark, tmp_path):
    from tessera.functions.cdc import cdc_json, to_cdc
    from tessera.operators.sinks import emit_events

    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, iupd string")
    out = str(tmp_path / "events")
    emit_events(cdc_json(to_cdc(df, ["id", "iupd"], now_us=5_000)), path=out)
    back = spark.read.schema("key string, value string").json(out)
    got = rows(back.select("key", F.get_json_object("value", "$.after.iupd").alias("iupd"),
                           F.get_json_object("value", "$.ts_ms").alias("ms")), "key", "iupd", "ms")
    assert got == [("1", "a", "5"), ("2", "b", "5")]


def test_redaction_of_adjacent_identifiers(spark):
    texts = {
        "Targa AB123CD EF456GH fine": "Targa <IT_VEHICLE_PLATE> <IT_VEHICLE_PLATE> fine",
        "00743110157 12345670017 00743110157": "<IT_VAT_CODE> <IT_VAT_CODE> <IT_VAT_CODE>",
        "900743110157 00743110157": "900743110157 <IT_VAT_CODE>",
        "AB1234567 U1ABCDEFGH AB1234567K 1234567AB": "<IT_PASSPORT> U1ABCDEFGH <IT_DRIVER_LICENSE> <IT_IDENTITY_CARD>",
        "xAB123CD AB123CD_ AB123CD": "xAB123CD AB123CD_ <IT_VEHICLE_PLATE>",
        "": "", "nothing": "nothing",
    }
    df = spark.createDataFrame([(k, v) for k, v in texts.items()] + [(None, None)], "text string, want string")
    assert all(r.text_anon == r.want for r in pii.redact(df, "text", out_col="text_anon").collect())
    masked = pii.redact(df.limit(1), "text", mode="mask").first()
    assert masked.text == "Targa AB123** EF456** fine"


def test_knn_in_several_query_blocks(spark):
    import numpy as np

    from tessera.operators import vectors

    rng = np.random.default_rng(3)
    q, c = rng.standard_normal((23, 8)), rng.standard_normal((90, 8))
    schema = "{} long, embedding array<double>"
    qs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], schema.format("query_id"))
    cs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)] + [(90, c[7].tolist())], schema.format("vec_id"))
    got = {}
    for r in vectors.knn(qs, cs, 4, block=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    every = np.vstack([c, c[7]])
    cos = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (every / np.linalg.norm(every, axis=1, keepdims=True)).T
    want = np.lexsort((np.broadcast_to(np.arange(91), cos.shape), np.round(1 - cos, 12)), axis=1)[:, :4]
    assert {i: [v for _, v in sorted(rows)] for i, rows in got.items()} == {i: w.tolist() for i, w in enumerate(want)}


def test_cross_overlap_with_one_very_wide_range(spark):
    short = [(i, "A" if i % 2 else "B", i * 10, i * 10 + 12) for i in range(20)]
    data = [*short, (99, "C", 5, 10**18 * 3)]
    df = spark.createDataFrame([(k, a, str(lo), str(hi)) for k, a, lo, hi in data], "row_key long, abi string, l string, h string").select(
        "row_key", "abi", F.col("l").cast("decimal(38,0)").alias("low_range"), F.col("h").cast("decimal(38,0)").alias("high_range"))
    got = {(r.a_key, r.b_key) for r in ranges.overlap_cross(df).collect()}
    want = {(a[0], b[0]) for a in data for b in data if a[1] != b[1] and (a[2], a[0]) < (b[2], b[0]) and b[2] <= a[3]}
    assert got == want


def test_main_inside_a_dropped_element_keeps_its_text():
    inside = "<body><form>out<main>kept <nav>gone</nav>too</main></form><p>rest</p></body>"
    assert text.extract_text(inside) == "kept\ntoo"
    assert text.extract_text("<body><form>gone</form>kept</body>") == "kept"


def test_tables_of_another_format_are_refused(spark, tmp_path):
    from tessera.operators import sinks

    df = spark.createDataFrame([(1, "a", 1)], "k long, v string, _ts long")
    spark.sql("DROP TABLE IF EXISTS merge_target")
    assert sinks.create_or_merge(df, "merge_target", ["k"], "_ts", location=str(tmp_path / "t")) == "created"
    newer = spark.createDataFrame([(1, "b", 2), (2, "c", 2)], "k long, v string, _ts long")
    assert sinks.create_or_merge(newer, "merge_target", ["k"], "_ts") == "merged"
    assert rows(spark.table("merge_target"), "k", "v") == [(1, "b"), (2, "c")]
    with pytest.raises(ValueError, match="stored as parquet"):
        sinks.create_or_merge(newer, "merge_target", ["k"], "_ts", fmt="json")
    spark.sql("DROP TABLE merge_target")


def test_a_merge_beside_another_loses_neither_load(spark, tmp_path, monkeypatch):
    from tessera.operators import sinks

    df = spark.createDataFrame([(1, "a", 1)], "k long, v string, _ts long")
    mine = spark.createDataFrame([(2, "mine", 2)], df.schema)
    other = spark.createDataFrame([(1, "other", 2), (3, "other", 2)], df.schema)
    spark.sql("DROP TABLE IF EXISTS merge_race")
    sinks.create_or_merge(df, "merge_race", ["k"], "_ts", location=str(tmp_path / "t"))
    frame, calls = sinks.upsert_frame, []

    def raced(*args):
        calls.append(args)
        out = frame(*args)
        if len(calls) == 1:  # another load swaps the table while this one writes
            sinks.create_or_merge(other, "merge_race", ["k"], "_ts")
        return out

    monkeypatch.setattr(sinks, "upsert_frame", raced)
    assert sinks.create_or_merge(mine, "merge_race", ["k"], "_ts") == "merged"
    assert len(calls) == 3
    assert rows(spark.table("merge_race"), "k", "v") == [(1, "other"), (2, "mine"), (3, "other")]
    spark.sql("DROP TABLE merge_race")


def test_jdbc_reader_takes_the_query_as_a_table():
    from tessera.sources.tables import read_jdbc

    class Reader:
        def __init__(self):
            self.options = {}

        def format(self, _):
            return self

        def option(self, k, v):
            self.options[k] = v
            return self

        def load(self):
            return self.options

    class Session:
        read = Reader()

    options = read_jdbc(Session(), "jdbc:x", "SELECT 1 AS a", "a", 0, 9, 3)
    assert options["dbtable"] == "(SELECT 1 AS a) q" and "query" not in options


def test_a_cluster_without_a_shared_folder_is_an_error():
    from tessera.session import checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_days_are_loaded_once_over_several_runs(spark, tmp_path):
    from tessera.streaming import jobs

    def deliver(n, *days):
        cols = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
        data = [(i, dt.datetime(2024, 1, d, 5), 1, "a", 0.0, "") for i, d in enumerate(days)]
        spark.createDataFrame(data, cols).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    path = {x: str(tmp_path / x) for x in ("in", "history", "ledger", "ckpt")}
    spark.createDataFrame([(dt.date(2024, 1, 1), "a", 7)], "day date, event_type string, total long").write.parquet(path["history"] + "/batch_id=-1")
    spark.createDataFrame([(dt.date(2024, 1, 1),)], "day date").write.parquet(path["ledger"] + "/batch_id=-1")
    results = []
    for days in ((1, 2, 2, 6), (2, 3, 9), (20,)):
        deliver(0, *days)
        got = jobs.ledgered_daily_load(spark, path["in"], path["history"], path["ledger"], path["ckpt"])
        results.append({r.day.day: r.total for r in got.collect()})
    assert results[0] == {1: 7, 2: 2}            # 6 is open; day 1 was loaded before
    assert results[1] == {1: 7, 2: 2, 6: 1}      # the late 2 and 3 come after their days were closed
    assert results[2] == {1: 7, 2: 2, 6: 1, 9: 1}
    assert {r.day.day for r in spark.read.parquet(path["ledger"]).collect()} == {1, 2, 6, 9}


def test_redaction_of_other_spellings(spark):
    texts = {
        "4111 1111 1111 1111": "<CREDIT_CARD>", "4111-1111-1111-1111": "<CREDIT_CARD>", "4111 1111-1111 1111": "4111 1111-1111 1111",
        "3782 822463 10005": "<CREDIT_CARD>", "4111 1111 1111 1112": "4111 1111 1111 1112",
        "DE89370400440532013000": "<IBAN_CODE>", "DE89370400440532013001": "DE89370400440532013001", "de89 3704 0044 0532 0130 00.": "<IBAN_CODE>.",
        "IT60 X054 2811 1010 0000 0123 456": "<IBAN_CODE>", "IT60 X054 2811 1010 0000 0123 456 OK": "<IBAN_CODE> OK", "xIT60X0542811101000000123456": "xIT60X0542811101000000123456",
        "IT60X05428111010000001234567": "IT60X05428111010000001234567", "GB29 NWBK 6016 1331 9268 19, FR1420041010050500013M02606": "<IBAN_CODE>, <IBAN_CODE>",
        "rssmra85t10a562s": "<IT_FISCAL_CODE>", "RSSMRA85T10A562S": "<IT_FISCAL_CODE>", "rssmra85t10a562t": "rssmra85t10a562t",
        "333 1234567": "<PHONE_NUMBER>", "333 123 4567, 06 1234567": "<PHONE_NUMBER>, <PHONE_NUMBER>", "+39 333 1234567": "<PHONE_NUMBER>", "3331234567": "<PHONE_NUMBER>",
        "00743110157": "<IT_VAT_CODE>", "a@b.it333 1234567": "<EMAIL_ADDRESS>333 1234567",
    }
    df = spark.createDataFrame(list(texts.items()), "text string, want string")
    assert {r.text: r.out for r in pii.redact(df, "text", out_col="out").collect()} == texts
    assert pii.redact(spark.createDataFrame([("rssmra85t10a562s",)], "t string"), "t", "mask").first()[0] == "rssmra**********"


def test_overlapping_spans_keep_the_best():
    spans = [(0, 10, "PHONE_NUMBER", 0.4), (3, 8, "IT_VEHICLE_PLATE", 0.8), (8, 12, "CREDIT_CARD", 1.0), (11, 14, "IT_PASSPORT", 0.8), (12, 14, "IT_PASSPORT", 0.8)]
    assert pii.resolved(spans) == [(3, 8, "IT_VEHICLE_PLATE", 0.8), (8, 12, "CREDIT_CARD", 1.0), (12, 14, "IT_PASSPORT", 0.8)]
    assert pii.resolved([(0, 5, "IT_PASSPORT", 0.8), (0, 6, "IT_VEHICLE_PLATE", 0.8)]) == [(0, 6, "IT_VEHICLE_PLATE", 0.8)]
    rnd = random.Random(2)
    for _ in range(200):
        many = [(a, a + rnd.randint(1, 6), rnd.choice(pii.PII_ENTITIES), rnd.choice([0.4, 0.8, 1.0])) for a in (rnd.randint(0, 40) for _ in range(12))]
        kept = pii.resolved(many)
        assert all(a[1] <= b[0] for a, b in zip(kept, kept[1:]))
        for s in many:  # what went overlaps something at least as good
            assert s in kept or any(k[0] < s[1] and s[0] < k[1] and k[3] >= s[3] for k in kept)


def test_span_table(spark):
    df = spark.createDataFrame([("é AB123CD x@y.it",), (None,), ("none",)], "t string")
    got = [r.spans for r in pii.pii_spans(df, "t").collect()]
    assert [tuple(s) for s in got[0]] == [(2, 9, "IT_VEHICLE_PLATE", 0.8), (10, 16, "EMAIL_ADDRESS", 1.0)]
    assert got[1] is None and got[2] == []


def test_title_match_of_any_id(spark):
    from tessera.operators import status

    ids = ["3f2a-77", "3f2a", "3f2a-7", "12", "1", "a b", "ID: 9", None, "x.y"]
    titles = [(1, "Incident [ID: 3f2a-77] - x"), (2, "ID: 12"), (3, "[ID: a b] ID: 1."), (4, "Id: 1"), (5, None), (6, "ID: ID: 9"), (7, "[ID: x.y.z]"), (8, "ID: ")]
    inc = spark.createDataFrame([(i,) for i in ids], "id string")
    rep = spark.createDataFrame([(i, t, "open") for i, t in titles], "report_id long, title string, aggregate_state string")
    exact = {r.id: r.report_id for r in status.match_by_title(inc, rep).collect()}
    assert exact == {"3f2a-77": 1, "3f2a": None, "3f2a-7": None, "12": 2, "1": 3, "a b": 3, "ID: 9": 6, None: None, "x.y": 7}
    part = {r.id: r.report_id for r in status.match_by_title(inc, rep, compat=True).collect()}
    assert part == {i: min((n for n, t in titles if i is not None and t and f"ID: {i}" in t), default=None) for i in ids}
    plan = status.match_by_title(inc, rep, compat=True)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert [r.report_id for r in status.match_by_title(inc.limit(0), rep).collect()] == []
    assert {r.report_id for r in status.match_by_title(inc, rep.limit(0)).collect()} == {None}


def test_knn_prunes_and_stays_exact(spark):
    """Clustered vectors: most cells are never visited; hot cells are split; the hits are those of brute force."""
    import numpy as np

    from tessera.operators import vectors

    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 12))
    sizes = [1200] + [60] * 29  # one cluster holds much of the corpus
    data = np.concatenate([c + 0.03 * rng.normal(size=(n, 12)) for c, n in zip(centres, sizes)])
    data = np.concatenate([data, data[:5]])  # repeated vectors tie
    cs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)] + [(90001, [0.0] * 12), (90002, None), (90003, [float("nan")] * 12)],
                               "vec_id long, embedding array<double>")
    asked = np.concatenate([centres + 0.02 * rng.normal(size=centres.shape), data[:40] * 3.0, rng.normal(size=(5, 12))])
    qs = spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in enumerate(asked)] + [("zero", [0.0] * 12), ("null", None)], "query_id string, embedding array<double>")
    got = {}
    for r in vectors.knn(qs, cs, 4, block=50, pivots=40).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.distance))
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    dist = np.round(1 - unit(asked) @ unit(data).T, 12)
    for i, row in enumerate(dist):
        order = sorted(range(len(data)), key=lambda j: (row[j], j))[:4]
        assert [(k, j, d) for k, j, d in sorted(got.pop(f"q{i}"))] == [(n + 1, j, pytest_approx(row[j])) for n, j in enumerate(order)]
    assert not got  # no hits for queries without a direction
    placed, at, bounds = vectors.cells(vectors._usable(cs, "vec_id", "embedding"), 50, 40)
    first = vectors.nearest_cell(vectors._usable(qs, "query_id", "embedding"), at, bounds)
    kth = np.sort(dist, axis=1)[:, 3]
    far = spark.createDataFrame([(f"q{i}", float(d)) for i, d in enumerate(kth)], "id string, far double")
    others = vectors.other_cells(first.join(far, "id"), at, bounds)
    pairs = sum(int(bounds[r.cell, 0]) for r in first.collect()) + sum(int(bounds[r.cell, 0]) for r in others.collect())
    assert bounds[:, 0].sum() == len(data) and len(at) == 40
    assert pairs < 0.5 * len(asked) * len(data)


def pytest_approx(x):
    import pytest

    return pytest.approx(x, abs=2e-12)


def test_knn_of_nothing(spark):
    from tessera.operators import vectors

    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    one = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    q = one.withColumnRenamed("vec_id", "query_id")
    assert vectors.knn(q, none).count() == 0 and vectors.knn(q.limit(0), one).count() == 0
    assert [tuple(r) for r in vectors.knn(q, one, 3).collect()] == [(1, 1, 0.0, 1)]


def test_owner_overlaps_where_starts_crowd(spark):
    """90 % of the starts in 0.1 % of the span, one owner with most ranges, wide, contained, equal, point and backward ranges."""
    rnd = random.Random(5)
    data = []
    for k in range(500):
        lo = rnd.randrange(0, 1000) if rnd.random() < 0.9 else rnd.randrange(0, 10**6)
        data.append((k, rnd.choice(["HOT", "HOT", "A", None]), lo, lo + rnd.choice([0, 1, 3, 10, -2])))
    data += [(600, "HOT", 0, 10**30), (601, "HOT", 500, 10**6), (602, "HOT", 500, 10**6), (603, "A", 10**6, 10**6), (604, "A", 10**6, 10**6), (605, "A", 5, None)]
    df = spark.createDataFrame([(k, o, None if lo is None else str(lo), None if hi is None else str(hi)) for k, o, lo, hi in data],
                               "row_key int, abi string, low_range string, high_range string")
    df = df.select("row_key", "abi", *[F.col(c).cast("decimal(38,0)").alias(c) for c in ("low_range", "high_range")])
    out = ranges.overlap_owner_all(df, rows_per_bucket=40, run=16)
    want = sorted((a[1], a[0], b[0]) for a in data for b in data if a[1] is not None and a[1] == b[1] and a[3] is not None and b[3] is not None
                  and b[3] >= b[2] and a[2] <= b[2] <= a[3] and (a[2], a[0]) < (b[2], b[0]))
    assert rows(out, "abi", "a_key", "b_key") == want
    assert ranges.overlap_owner_all(df.limit(0)).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    crowded = ranges._scanned(df.where("low_range is not null"), ["low_range", "row_key"], 40).groupBy("_b").count().collect()
    assert len(crowded) > 8 and max(r["count"] for r in crowded) < 120


def test_registry_files_with_headers_of_their_own(spark, tmp_path):
    from tessera.sources.delimited import load_registry

    (tmp_path / "a.txt").write_text('id;code\n9;9/0000003IM/\n7;bad\n8\n')
    (tmp_path / "b.txt").write_text('code;id\n9/0000004IM/;3\n"x;9/0000009IM/";1\n')
    (tmp_path / "c.txt").write_text('"note; long" ; " code "\n"a;b;c"; "9/0000005IM/ "\n"a;b;c\n""\n')
    valid, rejects = load_registry(spark, str(tmp_path), "code", r"^9/[0-9]{7}IM/$")
    assert rows(valid, "code") == [("9/0000003IM/",), ("9/0000004IM/",), ("9/0000005IM/",)]
    got = sorted((r.file[-5:], r.line_no, r.value, r.reason) for r in rejects.collect())
    assert got == [("a.txt", 3, "bad", "invalid format"), ("a.txt", 4, "N/D", "missing column"), ("b.txt", 3, "x;9/0000009IM/", "invalid format"),
                   ("c.txt", 3, "b", "invalid format"), ("c.txt", 4, "N/D", "missing column")]
    (tmp_path / "d.txt").write_text("other;id\n1;2\n")
    with pytest_raises(ValueError, "d.txt"):
        load_registry(spark, str(tmp_path), "code", ".")


def pytest_raises(kind, match):
    import pytest

    return pytest.raises(kind, match=match)


def test_carts_of_several_payments(spark):
    import base64

    from tessera.operators import payloads

    def event(payments, cards=("CP",)):
        meta = "".join(f"<mapEntry><key>tipoVersamento</key><value>{c}</value></mapEntry>" for c in cards)
        cart = "".join(f"<payment><creditorReferenceId>{iuv}</creditorReferenceId><fiscalCodePA>{ec}</fiscalCodePA>" + (
            "" if entries is None else "<metadata>" + "".join(f"<mapEntry><key>{k}</key><value>{v}</value></mapEntry>" for k, v in entries) + "</metadata>") + "</payment>"
            for iuv, ec, entries in payments)
        return base64.b64encode(f"<s:Envelope><s:Body><n:pspNotifyPaymentV2><fee>1</fee><additionalPaymentInformations><metadata>{meta}</metadata>"
                                f"</additionalPaymentInformations><paymentList>{cart}</paymentList></n:pspNotifyPaymentV2></s:Body></s:Envelope>".encode()).decode()

    code = ("codiceConvenzione", "C1")
    docs = {
        1: event([("i1", "e1", [code])]),
        2: event([("i1", "e1", [code]), ("i2", "e2", None), ("i3", "e3", [("x", "y"), ("codiceConvenzione", "C3")])]),
        3: event([("i1", "e1", [("codiceConvenzione", "C2"), ("x", "y")]), ("i2", "e2", [("x", "y")])]),
        4: event([("i1", "e1", [code])], ("PO", "XX")), 5: event([]), 6: event([("i1", "e1", [code, ("codiceConvenzione", "C9")])]),
    }
    df = spark.createDataFrame([(i, "c", "P", "pspNotifyPaymentV2", "REQ", d) for i, d in docs.items()],
                               "event_id long, ccp string, psp string, tipo_evento string, sotto_tipo_evento string, payload string")
    df = df.withColumn("inserted_ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    paid = payloads.agreement_payments(df, "2023-01-01", "2025-01-01", "P")
    assert rows(paid, "event_id", "iuv", "ec", "cod_conv") == [
        (1, "i1", "e1", "C1"), (2, "i1", "e1", "C1"), (2, "i3", "e3", "C3"), (3, "i1", "e1", "C2"), (6, "i1", "e1", "C1"), (6, "i1", "e1", "C9")]
    results = spark.createDataFrame([(10, "2024-01-02", "e3", "i3", "c", "KO")], "event_id long, inserted_ts string, id_dominio string, iuv string, ccp string, outcome string")
    assert (2, "i1") in rows(payloads.exclude_ko(paid, results), "event_id", "iuv") and (2, "i3") not in rows(payloads.exclude_ko(paid, results), "event_id", "iuv")


def test_entity_merge_of_repeated_updates(spark):
    from tessera.operators.registry import entity_merge

    target = spark.createDataFrame([("k", "a", "b"), ("t", "x", None)], "id string, c1 string, c2 string")
    updates = spark.createDataFrame([("k", "new", None, 1), ("k", None, "late", 3), ("k", "older", "early", 2), ("u", None, "v", 1)], "id string, c1 string, c2 string, seq int")
    assert rows(entity_merge(target, updates, ["id"], "seq"), "id", "c1", "c2") == [("k", "older", "late"), ("t", "x", None), ("u", None, "v")]


def test_distinct_counts_over_prefix_sets(spark):
    rng = random.Random(8)
    facts = [(rng.choice(["01", "02", "03", None]), rng.choice(["o1", "o2", None]), rng.choice([None, *map(str, range(40))])) for _ in range(500)]
    registry = [("01", "p"), ("02", "p"), ("02", "q"), ("03", "q"), ("09", "r"), ("01", None)]
    got = joins.distinct_by_registry(spark.createDataFrame(facts, "pre string, org string, v string"),
                                     spark.createDataFrame(registry + registry[:2], "pre string, who string"), "pre", "v", ["org"], "who", "n")
    found = {}
    for pre, org, v in facts:
        for key, who in registry:
            if v is not None and key == pre:
                found.setdefault((who, org), set()).add(v)
    assert {(r.who, r.org): r.n for r in got.collect()} == {k: len(x) for k, x in found.items()}


@pytest.mark.parametrize("match", ["prefix", "prefix+domain"])
def test_registry_fan_out_is_whole_and_spread_over_tasks(spark, match):
    orgs = ["o1", "o2", "o3", None]
    opts = [(i, f"{i % 4:02d}{i:013d}", orgs[i % 3]) for i in range(400)] + [(400, None, "o1"), (401, "0", "o1"), (402, "", None), (403, "12", "o2"), (403, "12", "o2")]
    registry = [(seg, f"p{i % 7}", orgs[i % 4]) for seg in (0, 1, 2, 123, None) for i in range(joins.REGISTRY_RUN * 2 + 9)] + [(9, None, "o2")]
    got = joins.partner_match(spark.createDataFrame(opts, "po_id long, iuv string, organization_fiscal_code string").coalesce(1),
                              spark.createDataFrame(registry, "segregazione int, id_intermediario_pa string, id_dominio string"), match)
    assert got.columns == ["po_id", "iuv", "organization_fiscal_code", "iuv_prefix", "segregazione", "id_intermediario_pa", "id_dominio", "seg_key"]
    want = Counter((*o, *r) for o in opts for r in registry if o[1] is not None and r[0] is not None and o[1][:2] == str(r[0])[:2].rjust(2, "0")
                   and (match == "prefix" or None not in (o[2], r[2]) and o[2] == r[2]))
    rows = got.select(*got.columns[:3], *got.columns[4:7], F.spark_partition_id().alias("task")).collect()
    assert Counter(tuple(r)[:6] for r in rows) == want
    assert max(Counter(r.task for r in rows).values()) < len(rows) / 2  # one task held them all


def test_one_prefix_is_spread_over_tasks_without_broadcast(spark):
    opts = [(i, f"07{i:013d}") for i in range(400)] + [(5, "070000000000005"), (400, None), (401, "7"), (402, "08")]
    registry = [(seg, f"p{i % 7}") for seg in (7, None, 9) for i in range(joins.REGISTRY_RUN + 9)]
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = joins.partner_match(spark.createDataFrame(opts, "po_id long, iuv string"), spark.createDataFrame(registry, "segregazione int, id_intermediario_pa string"))
        rows = got.select("po_id", "iuv", "segregazione", "id_intermediario_pa", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert Counter(tuple(r)[:4] for r in rows) == Counter((*o, *r) for o in opts for r in registry if r[0] == 7 and (o[1] or "").startswith("07"))
    assert max(Counter(r.task for r in rows).values()) < len(rows) / 2  # the prefix was one task's


def test_sketches_of_days_merge_to_one_pass(spark):
    facts = spark.range(60_000).selectExpr("id % 3 AS grp", "id % 7 AS day", "cast(id % 25000 AS string) AS v")
    once = {r.grp: r.n for r in joins.merge_sketches(joins.distinct_sketches(facts, "v", ["grp"]), ["grp"], "n").collect()}
    days = {r.grp: r.n for r in joins.merge_sketches(joins.distinct_sketches(facts, "v", ["grp", "day"]), ["grp"], "n").collect()}
    true = {r.grp: r.n for r in facts.groupBy("grp").agg(F.count_distinct("v").alias("n")).collect()}
    assert once.keys() == days.keys() == true.keys()
    for grp, n in true.items():
        assert abs(once[grp] - n) <= 3 * joins.SKETCH_ERROR * n and abs(days[grp] - n) <= 3 * joins.SKETCH_ERROR * n
        assert abs(once[grp] - days[grp]) <= 2 * joins.SKETCH_ERROR * n


def test_upsert_rewrites_only_the_partitions_it_changes(spark, tmp_path):
    from tessera.operators.sinks import upsert_partitions

    def load(data):
        df = spark.createDataFrame(data, "k string, month string, v string, ts int")
        return upsert_partitions(path, df, ["k", "month"], "ts", F.col("month"))

    def files():
        return {f: f.stat().st_mtime_ns for f in (tmp_path / "gold").rglob("*.parquet")}

    path = str(tmp_path / "gold")
    load([(f"k{i}", m, "old", 1) for i in range(20) for m in ("2024-01", "2024-02")] + [("k", None, "old", 1)])
    before = files()
    for _ in range(2):  # a repeated load changes nothing more
        out = load([("k1", "2024-02", "newer", 3), ("k1", "2024-02", "new", 2), ("k77", "2024-03", "new", 2)])
    after = files()
    assert {f: t for f, t in after.items() if "2024-01" in str(f) or "none" in str(f)} == {
        f: t for f, t in before.items() if "2024-02" not in str(f)}
    got = {(r.k, r.month): r.v for r in out.collect()}
    want = {(f"k{i}", m): "old" for i in range(20) for m in ("2024-01", "2024-02")} | {("k", None): "old"}
    assert got == want | {("k1", "2024-02"): "newer", ("k77", "2024-03"): "new"} and out.count() == len(got)


def test_a_repeated_batch_of_events_is_sent_once(spark, tmp_path):
    from tessera.operators.sinks import emit_events

    for topic in ([], ["'x' AS topic"]):
        path = str(tmp_path / f"events{len(topic)}")
        for batch, n in (("a", 3), ("b", 2), ("a", 3)):
            emit_events(spark.range(n).selectExpr(f"concat('{batch}', id) AS key", "'{}' AS value", *topic), path, batch=batch)
        assert rows(spark.read.json(path), "key", "batch") == [("a0", "a"), ("a1", "a"), ("a2", "a"), ("b0", "b"), ("b1", "b")]


def test_events_are_written_compressed(spark, tmp_path):
    from tessera.operators.sinks import emit_events

    events = spark.range(1000).selectExpr("cast(id AS string) AS key", "concat(repeat('name', 50), id) AS value", "concat('t', id % 2) AS topic")
    for name, df in (("plain", events.drop("topic")), ("topics", events)):
        emit_events(df, str(tmp_path / name), batch="b")
        files = [f for f in (tmp_path / name).rglob("part-*")]
        assert files and all(f.name.endswith(".json.gz") for f in files) and sum(f.stat().st_size for f in files) < 60_000
        assert rows(spark.read.json(str(tmp_path / name)), "key", "value") == sorted((str(i), "name" * 50 + str(i)) for i in range(1000))


def test_payments_are_computed_once(spark):
    """Judging the payments does not parse them a second time."""
    from tessera.operators import payloads

    parsed = spark.sparkContext.accumulator(0)

    def parse(i):
        parsed.add(1)
        return f"i{i}"

    paid = spark.range(20).select(F.col("id").alias("event_id"), F.lit("e").alias("ec"), F.udf(parse, "string")("id").alias("iuv"), F.lit("c").alias("ccp"))
    results = spark.createDataFrame([(1, "e", "i3", "c", "KO"), (0, "e", "i4", "c", "OK"), (1, "e", "i4", "c", "KO")],
                                    "inserted_ts long, id_dominio string, iuv string, ccp string, outcome string").withColumn("event_id", F.col("inserted_ts"))
    assert rows(payloads.exclude_ko(paid, results), "event_id") == [(i,) for i in range(20) if i != 3]
    assert parsed.value == 20


def test_prefixes_shared_by_rows_are_tried_once(spark):
    left = spark.createDataFrame([(1, "a", "12x"), (1, "a", "12x"), (2, "a", "1"), (3, "b", "12"), (4, None, "12"), (5, "a", None), (6, "a", "2")], "id int, k string, t string")
    right = spark.createDataFrame([("a", 1, "r1"), ("a", 1, "r1"), ("a", 12, "r2"), ("a", None, "r3"), (None, 1, "r4"), ("c", 1, "r5")], "o string, p int, r string")
    out = joins.prefix_residual_join(left, right, "k", "o", "t", "p")
    assert out.columns == ["id", "k", "t", "o", "p", "r"]
    assert rows(out.select(left.id, "r", "p"), "id", "r", "p") == [(1, "r1", 1)] * 4 + [(1, "r2", 12)] * 2 + [(2, "r1", 1)] * 2
    many = left.crossJoin(spark.range(200).select(F.col("id").alias("n")))
    wide = right.crossJoin(spark.range(300).select(F.col("id").alias("m")))
    joined = joins.prefix_residual_join(many, wide.where("r = 'r2'"), "k", "o", "t", "p")
    assert "Aggregate" in joined._jdf.queryExecution().optimizedPlan().toString() and joined.count() == 2 * 200 * 300


def test_recursive_chunks_are_handed_on_in_pieces(spark, monkeypatch):
    import pyarrow as pa

    df = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: f, raising=False)
    run = text.chunk_recursive(df, "doc_id", "text")
    texts = ["word " * 200_000, None, ""] * 40
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    got, largest = 0, 0
    for out in run(iter([batch])):
        got, largest = got + len(out), max(largest, out.nbytes)
        assert all(c == texts[i][s:s + len(c)] for i, s, c in zip(*(out.column(k).to_pylist()[:50] for k in (0, 2, 3))))
    assert got == 40 * len(text.split_spans(texts[0])) and largest < 10_000_000
