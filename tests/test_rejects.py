import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spanloom.operators import rejects

LINES = {
    "TERM,1,2,seiz,1": None,
    'TERM,"1","2",seiz,1': None,
    'TERM,1,2,"a, b",1': None,
    'TERM,1,2,"a ""b""",1': None,
    'TERM,1,2,"",1\r': None,
    "TERM, +1.5 ,1e2 ,seiz,1": None,
    "TERM,.5,5.,seiz,1": None,
    'TERM,1,2,la"bel,1': "broken_quoting",
    'TERM,1,2,"label"x,1': "broken_quoting",
    'TERM,1,2,""label"",1': "broken_quoting",
    'TERM,1,"2,label,1': "broken_quoting",
    'TERM,1,2,a"b,1,2': "broken_quoting",
    "TERM,1,2,seiz": "wrong_column_count",
    "TERM,1,2,seiz,1,": "wrong_column_count",
    "TERM\t1\t2\tseiz\t1": "wrong_column_count",
    "TERM,2,1,seiz,1": "invalid_value",
    "TERM,-1,2,seiz,1": "invalid_value",
    "TERM,1_0,20,seiz,1": "invalid_value",
    "TERM,nan,2,seiz,1": "invalid_value",
    "TERM,١,2,seiz,1": "invalid_value",
    "channel,start_time,stop_time,label,confidence": "invalid_value",
    "": None,
    "   ": None,
    '# note, "open': None,
}
SCHEMA = "line_id long, csv_bi_path string, line_no int, line_text string, reason string, extra int"


def test_reasons_and_rows(spark):
    data = [(i, "a", 7 + i, t, "clash", 1) for i, t in enumerate(LINES)] + [(100, "a", 3, "# duration = +5.5 secs", None, 1), (101, "b", 3, "# duration 5 secs", None, 1), (102, "b", 2, 'x "', None, 1), (103, None, None, None, None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    found = {r["line_id"]: r["reason"] for r in rejects.rejected_lines(df).collect()}
    assert found == {i: r for i, r in enumerate(LINES.values()) if r} | {101: "invalid_value"}
    loaded = rejects.loaded_rows(df).collect()
    assert {(r["start_time"], r["end_time"], r["duration"]) for r in loaded} == {(1.0, 2.0, 5.5), (1.5, 100.0, 5.5), (0.5, 5.0, 5.5)}
    assert rejects.loaded_rows(df.limit(0)).count() == 0 and rejects.rejected_lines(df.limit(0)).count() == 0


def by_hand(line: str) -> tuple[bool, int]:
    """State machine: whether quoting is broken, and fields outside quotes."""
    field = r'(?:[^",]*|"(?:[^"]|"")*")'
    broken = not re.fullmatch(rf"{field}(?:,{field})*", line)
    fields, inside = 1, False
    for c in line:
        inside ^= c == '"'
        fields += c == "," and not inside
    return broken, fields


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text('ab,"é', max_size=14), min_size=1, max_size=8))
def test_index_agrees_with_state_machine(lines):
    index = rejects.structural_index(pa.array(lines))
    got = list(zip(index["broken"].tolist(), index["fields"].tolist(), strict=True))
    assert got == [by_hand(x) for x in lines]


@pytest.mark.parametrize("secs,ok", [("5", True), ("0", False), ("-1", False), ("Infinity", False), ("99_0", False), ("", False), ("1e2", True)])
def test_duration(spark, secs, ok):
    df = spark.createDataFrame([(1, "a", 3, f"#duration={secs} secs\r")], "line_id long, csv_bi_path string, line_no int, line_text string")
    assert rejects.rejected_lines(df).count() == (0 if ok else 1)
