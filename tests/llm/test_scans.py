import random

from dotledger.llm.scans import confusions, reflow, repaired_text, scan_damage, skeleton, CONFUSIONS
from tests.conftest import rows

CLEAN = ["The particles were light-sensitive and the flask reached the yield in the sample.", "The nitrogen- and sulfur-doped sample was asked for. The emission of Quillfeather was shown in water."] * 4
SCAN = "ACTA PHOTOCARBONICA\n\nThe parti-\ncles were lig5t and the flask reacbed the\nyield in tbe water. The nitrogen-\nand light-\n\n– 36 –\x0c\nACTA PHOTOCARBONICA\nsensitive sample was a5ked for. The emis¬\nsion of Quillfeather was shown.\n\n12\n"


def _table(spark):
    texts = [(k, t) for k, t in enumerate(CLEAN)] + [(100, SCAN), (101, None), (102, ""), (103, "one line"), (104, "wrapped text of\ntwo lines.")]
    return spark.createDataFrame([(k, t, "x", "y") for k, t in texts], "doc_id bigint, text string, kind string, line string")


def test_damage(spark):
    got = set(rows(scan_damage(_table(spark)).filter("doc_id = 100").select("kind", "item")))
    assert {("line", "ACTA PHOTOCARBONICA"), ("line", "– 36 –"), ("line", "12")} == {g for g in got if g[0] == "line"}
    assert {("join", "particles"), ("join", "light-sensitive"), ("join", "emission")} == {g for g in got if g[0] == "join"}
    assert {("char", "reached"), ("char", "the"), ("char", "asked")} <= got
    assert scan_damage(_table(spark)).filter("doc_id <> 100").count() == 0


def test_text(spark):
    got = {r["doc_id"]: r["text"] for r in repaired_text(_table(spark)).collect()}
    assert got[100].startswith("The particles were") and "PHOTOCARBONICA" not in got[100] and "nitrogen- and light-sensitive sample was asked for" in got[100] and "emission of" in got[100]
    assert got[101] is None and got[102] == "" and got[103] == "one line" and got[104] == "wrapped text of two lines." and len(got) == len(CLEAN) + 5


def test_empty(spark):
    assert scan_damage(_table(spark).limit(0)).count() == 0


def test_confusions_keep_the_skeleton():
    for right, seen in CONFUSIONS:
        if (right, seen) not in {("t", "l"), ("i", "l")}:
            assert skeleton(right) == skeleton(seen), (right, seen)
    rng = random.Random(5)
    for _ in range(300):
        word = "".join(rng.choice("abcdehilmnorstuw") for _ in range(8))
        right, seen = rng.choice(CONFUSIONS)
        if right in word:
            damaged = word.replace(right, seen, 1)
            assert confusions(word, damaged) <= 1 and skeleton(word) == skeleton(damaged)


def test_paragraphs():
    lines = [{"line": x, "running": False} for x in ("One sen-", "tence.", "", "Two.")]
    assert [["".join(y if isinstance(y, str) else f"<{y[0]}|{y[1]}>" for y in p)] for p in reflow(lines)] == [["One <sen|tence>."], ["Two."]]


def test_nothing_is_left_out_for_its_length(spark):
    name = "poly" + "hydroxyethylmethacrylate" * 4  # over 80 letters
    clean = [f"The hydrothermal-treated dots and the {name} were kept. The internationalization of the hydrothermal step was shown."] * 4
    header = "JOURNAL OF VERY LONG RUNNING HEADERS THAT GO ON AND ON OVER THE WHOLE WIDTH OF THE PRINTED PAGE VOL 12"
    wrong = "intcrnati0nalizat1on".replace("z", "2")
    scan = f"{header}\nThe hydr0thermal-treated dots and the\n{name[:-1]}c were kept with\nthe {wrong} of it.\n\n{header}\nMore of it\nfollowed.\n"
    df = spark.createDataFrame([(k, t) for k, t in enumerate(clean)] + [(9, scan)], "doc_id bigint, text string")
    got = set(rows(scan_damage(df).select("kind", "item")))
    assert ("line", header) in got and ("char", "hydrothermal-treated") in got and ("char", name) in got and ("char", "internationalization") in got
    assert confusions("internationalization", wrong) == 4
