import datetime

from spanloom.plans import adapters, reference

MASTER = "master_id long, ingested_at timestamp, edf_path string, label string, channel string, start_time double, stop_time double, csv_path string, split string, session_key string, confidence double, is_valid boolean, status int"


def test_all_recordings_and_channels_are_met(spark, tmp_path):
    d = str(tmp_path)
    at = datetime.datetime(2020, 1, 1)
    spark.createDataFrame([(n, at, f"f{n}", "seiz", "FP1-F7", 10.0, 90.0, None, None, "s", 1.0, True, 1) for n in range(120)], MASTER).coalesce(1).write.parquet(f"{d}/master_full.parquet")
    spark.range(120 * 17, numPartitions=1).selectExpr("id as vec_id", "transform(sequence(1, 64), i -> cast((i * id) % 7 - 3 as float)) as embedding").write.parquet(f"{d}/embeddings.parquet")
    every = set(range(120))
    for name, channels in (("extract_segments", 17), ("event_mask_overlap", 17), ("derived_channels", 1), ("freq_grouping", 17)):
        got = [r["recording"] for r in reference.QUERIES[name](spark, d).select("recording").collect()]
        assert set(got) == every and len(got) == 120 * channels, name
    v = adapters.channels_of_vectors(spark, d)
    assert adapters.onto_recordings(adapters.annotations(spark, d), v.limit(0)).count() == 0
