"""Names, sizes, nested search and payload readers on hand-written cases."""

from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rentscope import schemas
from rentscope.functions import names
from rentscope.functions.nested import deep_find
from rentscope.operators import ingest
from rentscope.registry import fixtures as fx

LABELS = {
    "NVIDIA H100 SXM5 80GB": "H100_SXM",
    "H100 NVL": "H100_PCIE",
    "GH200": "H200",
    "GB200": "B200",
    "B300": "B300",
    "A100": "A100_40GB",
    "A100-SXM4-80GB": "A100_80GB",
    "L40S": "L40S",
    "L40": "L40",
    "GeForce RTX 4090 D": "RTX_4090",
    "RTX 3090": "RTX_3090",
    "RTX 4080": "RTX_4080",
    "RTX-3080": "RTX_3080",
    "RTX A4000": "A40",
    "Quadro RTX A6000": "RTX_A6000",
    "Tesla T4": "T4",
    "Tesla V100-PCIE-16GB": "V100",
    "MI300X": "MI300X",
    "my nvidia_card": "MY_CARD",
    "": "UNKNOWN",
    None: "UNKNOWN",
    "x" * 70: "X" * 64,
}

SIZES = {
    "80Gi": 85.899345920, "24G": 24.0, " 24g ": 24.0, "16384Mi": 17.179869184, "512M": 0.512, "48 GB": 48.0, "40": 40.0,
    "n/a": 0.0, "": 0.0, None: 0.0, "1.2.3": 0.0, "abcGi": 0.0, "1e1G": 10.0, "80dGi": 0.0,
}


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_labels(spark):
    df = one_column(spark, list(LABELS))
    rows = df.select("v", names.canonical_gpu_name(F.col("v")).alias("label")).collect()
    assert {r["v"]: r["label"] for r in rows} == LABELS
    rows = names.with_gpu_name(df, "v").collect()
    assert {r["v"]: r["gpu_name"] for r in rows} == LABELS


def test_sizes(spark):
    rows = one_column(spark, list(SIZES)).select("v", names.parse_size_gb(F.col("v")).alias("gb")).collect()
    for r in rows:
        assert r["gb"] == pytest.approx(SIZES[r["v"]]), r


def test_attributes(spark):
    attrs = "array<struct<key:string,value:string>>"
    rows = [
        ([("Region", "eu"), ("network-speed-down", "100.5")], "us"),
        ([("tier", "x"), ("Network-Speed-Down", "fast"), ("network-speed-down", "7")], "us"),
        ([], None),
    ]
    df = spark.createDataFrame(rows, f"a {attrs}, r string")
    found = df.select(
        names.attribute_place(F.col("a"), F.col("r")), names.attribute_number(F.col("a"), "network-speed-down")
    ).collect()
    assert [tuple(r) for r in found] == [("eu", 100.5), ("us", None), ("", None)]


json_values = st.recursive(
    st.one_of(st.none(), st.integers(0, 3), st.sampled_from(["", "a"])),
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(st.sampled_from("abk"), inner, max_size=3)),
    max_leaves=12,
)


def in_order(node, key):
    """Every value a search may return, first to last."""
    if isinstance(node, dict) and key in node:
        return [node[key]]
    children = node.values() if isinstance(node, dict) else node if isinstance(node, list) else []
    return [hit for child in children for hit in in_order(child, key)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(json_values, min_size=20, max_size=40))
def test_deep_find(spark, pages):
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(pages)], "i int, v string")
    for r in df.select("i", deep_find("k")(F.col("v")).alias("hit")).collect():
        hits = [h for h in in_order(pages[r["i"]], "k") if h is not None]
        assert (json.loads(r["hit"]) if r["hit"] is not None else None) == (hits[0] if hits else None)


def landed(spark, *bodies):
    """(run, provider, source, body) as the payload table."""
    rows = [(run, provider, source, body if isinstance(body, str) else json.dumps(body)) for run, provider, source, body in bodies]
    df = spark.createDataFrame(rows, "snapshot_id string, provider string, source string, payload string")
    return df.withColumn("captured_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))


def test_marketplace_defaults(spark):
    body = {"offers": [{"id": 7, "gpu_name": "RTX 4090", "num_gpus": 0, "dph_total": 1.0, "verified": True},
                       {"id": 8, "gpu_name": None, "num_gpus": 3, "gpu_ram": 24576, "dph_total": 1.0, "geolocation": "DE"}]}
    rows = {r["offer_id"]: r for r in ingest.ingest_marketplace(landed(spark, ("r", "vast", "marketplace", body))).collect()}
    assert list(rows["7"].asDict()) == schemas.OFFER_COLUMNS
    a, b = rows["7"], rows["8"]
    assert (a["gpu_count"], a["vram_gb"], a["price_per_gpu_hr"], a["reliability_score"], a["interruptible"]) == (1, 0.0, 1.0, 0.0, 1)
    assert (b["gpu_name"], b["gpu_name_raw"], b["vram_gb"], b["price_per_gpu_hr"], b["geography"]) == ("UNKNOWN", "", 24.0, 0.333333, "DE")
    assert json.loads(a["extra_json"]) == {"machine_id": None, "cuda_vers": None, "compute_cap": None, "verified": True}


def test_gpu_types_rows(spark):
    body = {"data": {"gpuTypes": [
        {"id": "a", "displayName": "A40", "memoryInGb": 48, "lowestPrice": {"minimumBidPrice": 0.2, "uninterruptablePrice": 0.4}},
        {"id": "b", "displayName": "", "lowestPrice": {"minimumBidPrice": None, "uninterruptablePrice": 0.0}},
        {"id": "c", "displayName": "L40", "lowestPrice": None},
    ]}}
    rows = ingest.ingest_gpu_types(landed(spark, ("r", "runpod", "gpu_types", body))).collect()
    assert {(r["offer_id"], r["price_per_gpu_hr"], r["interruptible"], r["gpu_name"]) for r in rows} == {
        ("a_spot", 0.2, 1, "A40"), ("a_ondemand", 0.4, 0, "A40"), ("b_ondemand", 0.0, 0, "B"),
    }


def test_monthly_prices(spark):
    body = [{"gpu": "a100", "ram": "80Gi", "interface": "SXM", "price": {"min": 730, "avg": 1460}},
            {"gpu": "t4", "ram": "16Gi", "price": {"min": 73, "avg": 0}}, {"gpu": "t4", "price": {"avg": None}}]
    rows = {r["offer_id"]: r for r in ingest.ingest_monthly_prices(landed(spark, ("r", "akash", "monthly_prices", body))).collect()}
    assert set(rows) == {"akash_a100_80Gi", "akash_t4_16Gi"}
    assert rows["akash_a100_80Gi"]["price_per_gpu_hr"] == 2.0 and rows["akash_a100_80Gi"]["gpu_name"] == "A100_40GB"
    assert rows["akash_t4_16Gi"]["price_per_gpu_hr"] == 0.1 and rows["akash_t4_16Gi"]["gpu_name_raw"] == "t4 16Gi"


def test_provider_list_shapes(spark):
    item = {"owner": "akash1abcdefghijklmnop", "uptime": 98, "attributes": [{"key": "GPU-Model", "value": "t4"}, {"key": "country", "value": "FR"}],
            "capabilities": {"gpu": {"models": [{"model": "t4"}, {"model": ""}, {"model": "a40"}]}}, "pricing": {"gpu": 0}}
    bare = {"owner": "x", "region": "us"}
    rows = ingest.ingest_provider_list(
        landed(spark, ("r1", "akash", "provider_list", {"providers": [item, bare]}), ("r2", "akash", "provider_list", [item]))
    ).collect()
    assert sorted((r["snapshot_id"], r["offer_id"]) for r in rows) == [
        (run, f"akash_prov_akash1abcdefghij_{gpu}") for run in ("r1", "r2") for gpu in ("a40", "t4")
    ]
    assert {(r["price_per_gpu_hr"], r["reliability_score"], r["geography"], r["vram_gb"]) for r in rows} == {(None, 0.98, "FR", None)}


def test_first_source_with_rows(spark):
    priced = [{"name": "T4", "price": 0.5, "spotPrice": 0}]
    page = '<html><script id="__NEXT_DATA__" type="x">%s</script></html>'
    rows = ingest.list_price_rows(
        landed(
            spark,
            ("api", "spheron", "price_list", {"gpus": priced}),
            ("api", "spheron", "price_page", page % json.dumps({"p": {"gpus": priced}})),
            ("page", "spheron", "price_list", {"gpus": [{"name": "T4", "price": 0}]}),
            ("page", "spheron", "price_page", page % json.dumps({"gpuPricing": [], "p": [{"pricing": priced}]})),
            ("none", "spheron", "price_list", "<h1>502</h1>"),
            ("none", "spheron", "price_page", page % json.dumps({"pricing": {"not": "a list"}})),
        )
    ).collect()
    found: dict[str, list] = {}
    for r in rows:
        found.setdefault(r["snapshot_id"], []).append(json.loads(r["extra_json"])["source"])
    assert found["api"] == ["spheron_api"] and found["page"] == ["spheron_html"]
    assert found["none"] == ["static_fallback_2026-04-15"] * 16


def test_bad_payload_is_logged_and_isolated(spark):
    table = landed(
        spark,
        ("r", "vast", "marketplace", "not json"),
        ("r", "runpod", "gpu_types", {"data": {"gpuTypes": []}}),
        ("r", "akash", "monthly_prices", [{"gpu": "t4", "ram": "16Gi", "price": {"avg": 73}}]),
    )
    offers = ingest.collect_run(table)
    log = ingest.collect_log(table, offers).collect()
    assert len(log) == 1
    assert (log[0]["vast_offers"], log[0]["runpod_offers"], log[0]["akash_offers"], log[0]["spheron_offers"]) == (0, 0, 1, 0)
    assert log[0]["errors"] == ["runpod: no rows", "vast: unreadable"]


def test_snapshot_id(spark):
    df = spark.sql("SELECT timestamp'2024-05-06 07:08:09.123456' AS t")
    assert df.select(ingest.make_snapshot_id(F.col("t"))).first()[0] == "snap_20240506_070809_123"


def test_numbers_as_texts(spark):
    """Quoted numbers count like plain ones; texts that are no numbers count as absent."""
    import json

    from rentscope.operators import ingest

    def landed(provider, source, body):
        return spark.createDataFrame([("s", "2024-01-01 00:00:00", provider, source, json.dumps(body))], "snapshot_id string, t string, provider string, source string, payload string").selectExpr(
            "snapshot_id", "CAST(t AS timestamp) AS captured_at", "provider", "source", "payload"
        )

    offer = {"id": 7, "gpu_name": "RTX 4090", "num_gpus": "2", "gpu_ram": "24576", "dph_total": "0.80", "reliability2": "bad"}
    (row,) = ingest.ingest_marketplace(landed("vast", "marketplace", {"offers": [offer]})).collect()
    assert (row["price_per_gpu_hr"], row["price_total_hr"], row["gpu_count"], row["vram_gb"], row["reliability_score"]) == (0.4, 0.8, 2, 24.0, 0.0)
    rows = ingest.ingest_price_list(landed("spheron", "price_list", [{"name": "L40S", "onDemandPrice": "0.86", "spotPrice": "n/a", "vram": "48"}])).collect()
    assert [(r["price_per_gpu_hr"], r["vram_gb"], r["interruptible"]) for r in rows] == [(0.86, 48.0, 0)]
    kind = {"id": "x", "displayName": "L4", "memoryInGb": "24", "lowestPrice": {"minimumBidPrice": "0.2", "uninterruptablePrice": None}}
    (row,) = ingest.ingest_gpu_types(landed("runpod", "gpu_types", {"data": {"gpuTypes": [kind]}})).collect()
    assert (row["price_per_gpu_hr"], row["vram_gb"]) == (0.2, 24.0)


def test_chosen_providers_only(spark, small_dir):
    from rentscope.operators import ingest
    from rentscope.registry import fixtures as fx

    found = ingest.collect_run(fx.payloads(spark, small_dir), providers=["akash"])
    assert {r["provider"] for r in found.select("provider").distinct().collect()} == {"akash"}


def test_a_deeply_nested_page_loses_only_its_own_rows(spark, small_dir):
    """100,000 levels under a wanted key: all others' rows come, the log says so, and pages are read in one place."""
    whole = fx.payloads(spark, small_dir)
    deep = '<script id="__NEXT_DATA__" type="application/json">{"gpus":' + "[" * 100_000 + "]" * 100_000 + "}</script>"
    pages = F.when(F.col("source") == "price_page", F.lit(deep)).otherwise(F.col("payload"))
    broken = whole.withColumn("payload", pages)
    rows = ingest.collect_run(broken)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    others = rows.filter("provider <> 'spheron'")
    assert others.count() == ingest.collect_run(whole).filter("provider <> 'spheron'").count() > 0

    def unreadable(payloads, offers):
        return {r[0] for r in ingest.collect_log(payloads, offers).filter(F.array_contains("errors", "spheron: unreadable")).select("snapshot_id").collect()}

    with_page = {r[0] for r in broken.filter("source = 'price_page'").select("snapshot_id").collect()}
    before = unreadable(whole, ingest.collect_run(whole))
    assert unreadable(broken, rows) == before | with_page and not with_page <= before
    texts = spark.createDataFrame([("[" * 100_000,), ('{"gpus":' + "[" * 100_000 + "1" + "]" * 100_000 + "}",), ('{"gpus":[1]}',), ("{gpus",), (None,)], "t string")
    assert [r[0] for r in texts.select(deep_find("gpus")(F.col("t"))).collect()] == [None, None, "[1]", None, None]


def test_pages_are_searched_once(spark, small_dir):
    """A condition on what was found does not search the pages again, and each task has one Python worker for it."""
    pages = fx.web_pages(spark, small_dir)
    for df in (ingest._page_lists(pages).filter("list IS NOT NULL"), ingest.ingest_price_page(pages)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and plan.count("find(") == 1, plan


def test_only_lists_are_prices(spark):
    texts = ['{"k": [1]}', '{"k": {"a": 1}}', '{"k": "[x"}', '{"k": []}', '{"k": null}', "no", None]
    found = one_column(spark, texts).select(deep_find("k", only=list)(F.col("v")).alias("f")).collect()
    assert [r["f"] for r in found] == ["[1]", None, None, "[]", None, None, None]


def test_providers_and_scripts_are_read_once(spark):
    """What holds for a provider is found below the listing of its models; a page's script is cut out once."""
    payloads = spark.createDataFrame([], schemas.PAYLOADS)

    def plan(rows):
        return rows._jdf.queryExecution().optimizedPlan().toString()

    listed = plan(ingest.ingest_provider_list(payloads.persist()))
    assert 0 <= listed.index("array_distinct") < listed.index("network-speed-down")
    assert plan(ingest._page_lists(payloads)).count("regexp_extract") == 1
    payloads.unpersist()
