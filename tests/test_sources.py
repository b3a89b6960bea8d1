"""Landed-file readers and extractors."""

import datetime as dt
import json

import pytest

from panelspark import catalog as C
from panelspark.operators import extract
from panelspark.sources import files, tables


def test_json_lines_observations(spark, tmp_path):  # S1
    p = tmp_path / "obs.jsonl"
    p.write_text("\n".join(json.dumps({"date": "2024-01-01", "source": "FRED", "series_id": "X", "value": v,
                                       "ingested_at": "2024-02-01T00:00:00+00:00"}) for v in (1.5, None)))
    df = files.read_json_observations(spark, str(p), iso_dates=True)
    rows = df.collect()
    assert [r.value for r in rows] == [1.5, None]
    assert rows[0].date == dt.date(2024, 1, 1) and dict(df.dtypes)["ingested_at"] == "timestamp"


SNB_TEXT = '''"CubeId";"devkum"
"PublishingDate";"2024-05-01 14:30"

"Date";"D0";"D1";"Value"
"2024-01";"M0";"EUR1";"0.9432"
"2024-01";"M0";"USD1";"0.8612"
"2024-02";"M0";"EUR1";""
"2024-03";"M0";"EUR1";"0.9512"
'''


def test_delimited_lines_with_preamble(spark, tmp_path):  # S2, P8, P5
    p = tmp_path / "devkum.csv"
    p.write_text(SNB_TEXT)
    s = next(x for x in C.SERIES if x.series_id == "devkum/EUR1")
    out = extract.extract_delimited(files.read_lines(spark, str(p)), s, file_col="file").collect()
    assert [(r.date, r.value, r.series_id, r.frequency) for r in out] == [
        ("2024-01", 0.9432, "devkum/EUR1", "monthly"), ("2024-03", 0.9512, "devkum/EUR1", "monthly")]


def test_delimited_code_absent_keeps_file(spark, tmp_path):  # reference: no column holds the code → no filter
    p = tmp_path / "snbgwdzid.csv"
    p.write_text('"Date";"D0";"Value"\n"2024-01-02";"SARON";"1.7"\n"2024-01-03";"SARON";"1.6"\n')
    s = C.Series("SNB", "snbgwdzid/ZIG", "x", "monetary", "percent", "daily", cube="snbgwdzid", code="ZIG")
    out = extract.extract_delimited(files.read_lines(spark, str(p)), s, file_col="file")
    assert out.count() == 2


WIDE = """STRUCTURE_NAME,MEASURE,ACTIVITY,ADJUSTMENT,TRANSFORMATION,FREQ,TIME_PERIOD,OBS_VALUE,Measure
KEI,PRVM,C,Y,GY,M,2024-01,1.5,Production
KEI,PRVM,C,Y,GY,M,2024-02,,Production
KEI,PRVM,C,Y,GY,M,2024-03,:,Production
KEI,PRVM,C,Y,GY,,2024-04,NaN,Production
KEI,PRVM,C,Y,GY,,2024-05,1e3,Production
KEI,PRVM,C,Y,GY,A,2024,2.0,Production
KEI,PRVM,C,N,GY,M,2024-01,9.9,Production
"""


def test_wide_csv_extract(spark, tmp_path):  # S3, P3, P4, P7, J2, G12, R22
    p = tmp_path / "kei.csv"
    p.write_text(WIDE)
    landed = files.read_wide_csv(spark, str(p))
    assert set(dict(landed.dtypes).values()) == {"string"}
    cat = extract.catalog_frame(spark, C.series_by_source("OECD"))
    out = sorted((r.date, r.value, r.series_id) for r in extract.extract_wide(landed, cat).collect())
    assert out == [("2024-01", 1.5, "KEI/CHE/PRVM/C/GY"), ("2024-05", 1000.0, "KEI/CHE/PRVM/C/GY")]


def test_iso_extract_takes_frequency_from_catalog(spark):  # D3
    obs = spark.createDataFrame([("CLVMNACSAB1GQCH", dt.date(2024, 1, 1), 1.0),
                                 ("CLVMNACSAB1GQCH", dt.date(2024, 4, 1), float("nan"))],
                                "series_id string, date date, value double")
    out = extract.extract_iso(obs, extract.catalog_frame(spark, C.SERIES)).collect()
    assert len(out) == 1 and out[0].frequency == "quarterly" and out[0].source == "FRED"


def test_tabs_csv(spark, tmp_path):  # S6
    p = tmp_path / "tabs.csv"
    p.write_text("tab_id,tab_name\n" + "\n".join(f"{i},{n}" for i, n in C.TABS) + "\n")
    assert [tuple(r) for r in files.read_tabs(spark, str(p)).collect()] == list(C.TABS)


def test_materialize_partitioned(spark, tmp_path):  # S10
    df = spark.createDataFrame([("growth", "A", 1.0), ("labour", "B", 2.0)], "indicator_category string, "
                               "series_id string, value double")
    path = str(tmp_path / "mart")
    tables.materialize(df, path, partition_by=("indicator_category",), sort_within=("series_id",))
    tables.materialize(df, path, partition_by=("indicator_category",))  # full rebuild, not append
    back = spark.read.parquet(path)
    assert back.count() == 2
    plan = back.filter("indicator_category = 'growth'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(indicator_category" in plan


def test_member_decided_after_value_coercion(spark, tmp_path):
    """The code seen only on rows with a missing value does not pick the column."""
    p = tmp_path / "cube.csv"
    p.write_text('"Date";"D0";"D1";"Value"\n"2024-01";"EUR1";"X";""\n"2024-01";"A";"EUR1";"0.9"\n'
                 '"2024-02";"B";"Y";"0.8"\n')
    s = next(x for x in C.SERIES if x.series_id == "devkum/EUR1")
    out = extract.extract_delimited(files.read_lines(spark, str(p)), s, file_col="file").collect()
    assert [(r.date, r.value) for r in out] == [("2024-01", 0.9)]


def test_every_row_after_the_header_is_kept(spark, tmp_path):
    """Years and quarters are data too: staging decides what they mean."""
    p = tmp_path / "devkum.csv"
    p.write_text('"CubeId";"devkum"\n\n"Date";"D0";"D1";"Value"\n"2024";"M0";"EUR1";"0.9"\n"2024-Q1";"M0";"EUR1";"0.8"\n'
                 '"2024-01";"M0";"EUR1";"0.7"\n"p;q";"M0";"EUR1";"0.6"\n')
    s = next(x for x in C.SERIES if x.series_id == "devkum/EUR1")
    out = extract.extract_delimited(files.read_lines(spark, str(p)), s, file_col="file").collect()
    assert sorted(r.date for r in out) == ["2024", "2024-01", "2024-Q1", "p;q"]


def test_file_without_header_raises(spark, tmp_path):
    (tmp_path / "good.csv").write_text('"Date";"D0";"Value"\n"2024-01";"EUR1";"0.9"\n')
    (tmp_path / "bad.csv").write_text("<html>try later</html>\n2024-01;x;1\n")
    s = next(x for x in C.SERIES if x.series_id == "devkum/EUR1")
    with pytest.raises(Exception, match="without a usable header"):
        extract.extract_delimited(files.read_lines(spark, str(tmp_path)), s, file_col="file").collect()


def test_cubes_in_one_pass(spark, tmp_path):
    (tmp_path / "cur.csv").write_text(SNB_TEXT)
    (tmp_path / "rates.csv").write_text('"CubeId";"snbgwdzid"\n"Date";"D0";"Value"\n"2024-01-02";"SARON";"1.7"\n'
                                        '"2024-01-02";"ZIG";"1.5"\n"2024-01-02";"XX";"9"\n')
    cat = extract.catalog_frame(spark, C.series_by_source("SNB"))
    out = extract.extract_cubes(files.read_lines(spark, str(tmp_path)), cat).collect()
    assert sorted((r.series_id, r.date, r.value) for r in out) == [
        ("devkum/EUR1", "2024-01", 0.9432), ("devkum/EUR1", "2024-03", 0.9512), ("devkum/USD1", "2024-01", 0.8612),
        ("snbgwdzid/SARON", "2024-01-02", 1.7), ("snbgwdzid/ZIG", "2024-01-02", 1.5)]
    (tmp_path / "odd.csv").write_text('"CubeId";"devkum"\n"Date";"D0";"Value"\n"2024-01";"ZZZ";"1"\n')
    with pytest.raises(Exception, match="no series code of its cube"):
        extract.extract_cubes(files.read_lines(spark, str(tmp_path)), cat).collect()


def test_wide_csv_files_keep_their_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("MEASURE,ACTIVITY,ADJUSTMENT,TRANSFORMATION,FREQ,TIME_PERIOD,OBS_VALUE\nPRVM,C,Y,GY,M,2024-01,1.5\n")
    (tmp_path / "b.csv").write_text("OBS_VALUE,TIME_PERIOD,FREQ,TRANSFORMATION,ADJUSTMENT,ACTIVITY,MEASURE,EXTRA\n2.5,2024-02,M,GY,Y,C,PRVM,x\n")
    landed = files.read_wide_csv(spark, str(tmp_path))
    out = extract.extract_wide(landed, extract.catalog_frame(spark, C.series_by_source("OECD")))
    assert sorted((r.date, r.value) for r in out.collect()) == [("2024-01", 1.5), ("2024-02", 2.5)]
    (tmp_path / "c.csv").write_text("NoResultsFound\n")
    with pytest.raises(files.LandedFileError):
        files.read_wide_csv(spark, str(tmp_path))


def test_empty_wide_file_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(files.LandedFileError):
        files.read_wide_csv(spark, str(tmp_path))
