import pytest

from dotledger.functions.units import parse_quantities, stated_unit
from dotledger.operators.quantities import common_quantities
from tests.conftest import rows

CASES = [
    ("110 °C", [("temperature", 11000)]), ("95 to 115 °C", [("temperature", 9500), ("temperature", 11500)]), ("521 ± 5 K", [("temperature", 24785)]), ("−25 C", [("temperature", -2500)]), ("408,15 K", [("temperature", 13500)]),
    ("≈ 3.01×10^2 Fahrenheit", [("temperature", 14944)]), ("440 (K)", [("temperature", 16685)]), ("-20 to -10 °C", [("temperature", -2000), ("temperature", -1000)]), ("80 - 90 °C", [("temperature", 8000), ("temperature", 9000)]), ("ambient", []),
    ("2 h 15 min", [("time", 8100)]), ("7h45min", [("time", 27900)]), ("5 hours and 10 minutes", [("time", 18600)]), ("3.5 day(s), then 17.5 h", [("time", 302400), ("time", 63000)]), ("12000s / 12 h", [("time", 12000), ("time", 43200)]),
    ("4.5 h; 45 min", [("time", 16200), ("time", 2700)]), ("five days", [("time", 432000)]), ("half an hour", [("time", 1800)]), ("overnight", []), ("≈ 13,800 s", [("time", 13800)]), ("30'", [("time", 1800)]),
    ("13,05 mL (0.5 M)", [("volume", 13050)]), ("16.31 mL of 10 % aqueous", [("volume", 16310)]), ("1,179 µL", [("volume", 1179)]), ("21 cm³", [("volume", 21000)]), ("17.81㎖", [("volume", 17810)]), ("0.053 dm3", [("volume", 53000)]), ("a few drops", []),
    ("0.48 kg (0.296 mol)", [("mass", 480000000), ("amount", 296000000)]), ("1.099e3 umol", [("amount", 1099000)]), ("1688㎎", [("mass", 1688000)]), ("700 W", []), ("0.5 M", []), ("10 %", []),
]


@pytest.mark.parametrize("cell, expected", CASES)
def test_grammar(cell, expected):
    assert [(q.dim, round(q.common)) for q in parse_quantities(cell)] == expected


def test_bare_numbers():
    assert [(q.dim, q.number) for q in parse_quantities("about 420")] == [(None, 420.0)]
    assert [q.number for q in parse_quantities("5-10")] == [5.0, 10.0]
    assert parse_quantities("2 portions") == [] and parse_quantities("") == []


@pytest.mark.parametrize("sentence, expected", [
    ("All precursor amounts below are given in mmol unless noted.", ("Precursor_Amount", "amount", 1e6, 0.0)), ("Readers should take temperatures as degrees Fahrenheit where no unit is printed.", ("Temperature", "temperature", 500 / 9, 32.0)),
    ("Note that heating times (minutes) refer to the sealed vessel.", ("Time", "time", 60.0, 0.0)), ("The unit of all solvent volumes in the tables is L.", ("Solvent_Volume", "volume", 1e6, 0.0)), ("Throughout this paper, lifetimes are quoted in nanoseconds.", None), ("Particle sizes are given in nm unless noted.", None),
])
def test_statements(sentence, expected):
    assert stated_unit(sentence) == expected


def test_operator_takes_units_from_the_paper(spark):
    schema = "row_uid bigint, doc_id string, T string, Temperature string, Precursor_Amount string, salt int, dim string"
    letters = spark.createDataFrame([(1, "7", "x", "95", "1 g; N/A; 2", 1, "d"), (2, "8", "x", "95", None, 1, "d"), (3, None, None, "20 °C", "", None, None), (4, "7", "x", "300 K", "3 g (5 mmol)", 2, "d"), (4, "7", "x", "300 K", "3 g (5 mmol)", 2, "d")], schema)
    sentences = spark.createDataFrame([("7", "All tеmperatures below are given in kelvin."), ("7", None), (None, "All temperatures are given in K."), ("7", "All precursor amounts below are given in mg unless noted.")], "pdf_name string, text string")
    got = rows(common_quantities(letters, "row_uid", "doc_id", ["Temperature", "Precursor_Amount"], ["Precursor_Amount"], sentences, "pdf_name", "text"))
    twice = [(4, "Temperature", 0, "temperature", 2685), (4, "Precursor_Amount", 0, "mass", 3000000), (4, "Precursor_Amount", 0, "amount", 5000000)] * 2
    assert got == sorted([(1, "Temperature", 0, "temperature", -17815), (1, "Precursor_Amount", 0, "mass", 1000000), (1, "Precursor_Amount", 2, "mass", 2000), (3, "Temperature", 0, "temperature", 2000), *twice], key=repr)
    assert common_quantities(letters.limit(0), "row_uid", "doc_id", ["Temperature"], [], sentences.limit(0), "pdf_name", "text").count() == 0
