import random

from dotledger.operators.text_stages import SECTION_ORDER, stabilize_sections


def _rules(labels):
    """The rules of the docstring, one block after another."""
    s, rank = list(labels), {x: k for k, x in enumerate(SECTION_ORDER)}

    def anchors():
        out, last = [], None
        for k, x in enumerate(s):
            if x in rank and x != last:
                out.append(k)
                last = x
        return out

    for left, right, unknown_only in (("intro", "methods", True), ("methods", "results_discussion", False)):
        a = anchors()
        for i, j in zip(a, a[1:]):
            if (s[i], s[j]) == (left, right):
                for k in range(i + 1, j):
                    if s[k] == "unknown" or not unknown_only and s[k] != "abstract":
                        s[k] = left
    a = anchors()
    for i in a:
        if s[i] == "results_discussion":
            j = next((j for j in a if j > i and s[j] == "conclusion"), None)
            for k in range(i + 1, j or 0):
                if s[k] != "abstract":
                    s[k] = "results_discussion"
    a, present = anchors(), set(s)
    for i in a:
        for j in a:
            if j > i and rank[s[i]] + 1 < rank[s[j]] and not any(x in present for x in SECTION_ORDER[max(1, rank[s[i]] + 1) : rank[s[j]]]):
                for k in range(i + 1, j):
                    if s[k] == "unknown":
                        s[k] = s[j]
    return ["intro"] * len(s) if all(x == "unknown" for x in s) else s


def test_against_the_rules(spark):
    rng = random.Random(4)
    docs = {d: [rng.choice([*SECTION_ORDER, "unknown", "unknown", "ignore"]) for _ in range(rng.randint(1, 9))] for d in range(300)}
    docs[999] = ["unknown", "unknown"]
    df = spark.createDataFrame([(d, k, x, "e") for d, xs in docs.items() for k, x in enumerate(xs)] + [(1000, 0, None, "e")], "d int, k int, s string, _x string")
    got = {}
    for r in stabilize_sections(df, "d", ["k"], "s").orderBy("d", "k").collect():
        got.setdefault(r["d"], []).append(r["s"])
    wrong = [(docs[d], got[d], _rules(docs[d])) for d in docs if got[d] != _rules(docs[d])]
    assert not wrong, wrong[:3]
    assert got[1000] == ["intro"] and stabilize_sections(df.limit(0), "d", ["k"], "s").count() == 0
