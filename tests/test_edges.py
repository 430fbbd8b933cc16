from mergewell.operators import remote_validator as R
from mergewell.plans import profiles as P
from mergewell.plans import pipelines as L
from mergewell.plans.pipelines import flagged_records
from mergewell.streaming import ingest


def test_answers_are_checked():
    good = '```json\n{"same_company": true, "confidence": 0.8, "reasoning": "x"}\n```'
    assert R.parse_answer(good) == {"same_company": True, "confidence": 0.8, "reasoning": "x"}
    for bad in ("", "no json", "[]", '{"same_company": "yes", "confidence": 1}', '{"same_company": true, "confidence": 7}'):
        assert R.parse_answer(bad)["confidence"] == 0.0


def test_retries():
    waits, answers = [], iter([(429, ""), (500, ""), (200, '{"same_company": true, "confidence": 1}')])
    assert R.ask(lambda _: next(answers), "a", "b", waits.append)["same_company"] and waits == [2.0, 4.0]


def test_remote_verdicts(spark):
    pairs = spark.createDataFrame([("a", "b", 0.8), ("c", "d", 0.9)], "label_a string, label_b string, score double")
    rows = R.remote_verdicts(pairs, lambda _: (200, '{"same_company": true, "confidence": 0.9}'), most_calls=1, pause=0).collect()
    assert [(r["label_a"], r["verdict"]["same_company"]) for r in rows] == [("c", True)]


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame([(1, "Acme Ltd ·", "Company"), (2, None, None), (3, "N/A", "Group")], ingest.SCHEMA)
    rows.write.parquet(str(tmp_path / "in"))
    ingest.flag_stream(ingest.arriving(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, flagged_records(rows, P.BALANCED).select(*got.columns).collect()))


def test_service_judges_inside_the_flow(spark):
    labels = ["Palo Alto Networks", "Palo auto network", "Stallion Nigeria Limited", "Stallion Group of Nigeria", "Nyanza Health Society", "Nyanza Health Societies Kenya"]
    masters = spark.createDataFrame([(i, x, "Company") for i, x in enumerate(labels, 1)], "id long, label string, type string")
    no = R.service_judge(lambda _: (200, '{"same_company": false, "confidence": 1}'), pause=0)
    yes = R.service_judge(lambda _: (200, '{"same_company": true, "confidence": 0.9, "reasoning": "r"}'), pause=0)
    unsure = R.service_judge(lambda _: (200, '{"same_company": true, "confidence": 0.2}'), pause=0)
    none = R.service_judge(lambda _: (200, ""), most_calls=0, pause=0)
    marks = {k: {r["id"]: r for r in L.validated_dedup(masters, j).collect()} for k, j in (("no", no), ("yes", yes), ("unsure", unsure), ("none", none))}
    open_ids = {i for i, r in marks["yes"].items() if r["ai_decision"]}
    assert open_ids and all('"reasoning":"r"' in marks["yes"][i]["ai_decision"] for i in open_ids)
    assert {i for i, r in marks["unsure"].items() if r["duplicate_status"] == "probable"} > open_ids
    for k in ("no", "none"):
        assert not any(r["ai_decision"] for r in marks[k].values()) and {i for i, r in marks[k].items() if r["duplicate_status"]} < {i for i, r in marks["yes"].items() if r["duplicate_status"]}
