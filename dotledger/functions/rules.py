"""Rule tables as data: pattern families that decide sections, property keywords, units and retention.

The patterns are fixed values that results depend on; all are written so that Java, Python and RE2 read them alike.
"""

from __future__ import annotations

#: Patterns of a heading by section, in the order in which a section wins.
SECTION_PATTERNS = {
    "conclusion": [r"\bconclusions?\b", r"\bsummary\b", r"\boutlook\b", r"\bperspectives?\b", r"\bfuture\s+work\b"],
    "results_discussion": [
        r"\bresults?\s*(?:and|&)\s*discussion\b", r"\bresults?\b", r"\bfindings?\b", r"\bperformance\b",
        r"\b(?:optical|photophysical|emission|luminescence|pl)\s+properties\b", r"\bdiscussion\b", r"\banalysis\b",
    ],
    "methods": [
        r"\bmaterials?\s*(?:and|&)\s*methods\b", r"\bexperimental(?:\s+sections?)?\b", r"\bmethods?\b", r"\bmethodology\b", r"\bsynthesis\b", r"\bpreparation\b", r"\bfabrication\b",
    ],
    "intro": [r"\bintroduction\b", r"\bbackground\b", r"\boverview\b", r"\bmotivation\b", r"\brelated\s+work\b", r"\bliterature\s+review\b"],
    "abstract": [r"\babstract\b", r"\bgraphical\s+abstract\b"],
    "ignore": [
        r"\barticle\s*info(?:rmation)?\b|\barticleinfo\b", r"\bkeywords?\b", r"\bhighlights?\b", r"\bcorrespondence\b", r"\bjournal\s+pre-?proofs?\b", r"\baccess(?:\s+metrics(?:\s+more)?)?\b",
        r"\bsupporting\s+information\b", r"\bsupplementary\s+(?:information|materials?)\b", r"\bappendix\b", r"\breferences?\b", r"\bbibliography\b", r"\backnowledg(?:e)?ments?\b",
        r"\bconflicts?\s+of\s+interest\b", r"\bcompeting\s+interests?\b", r"\bdata\s+availability\b",
    ],
}

#: Keywords of the properties in a sentence.
KEYWORDS = {
    "has_em": r"\bemission(?:\s+peak)?\b|\bpeak\s+emission\b|\b(?:λ|lambda)\s*[_\s-]*em\b|\bfluorescence\s+intensity\s+(?:was\s+observed\s+)?at\b|\bmax(?:\.|imum)?\s*(?:pl|photoluminescence)\s*(?:peak|wavelength)?\b|\boptimal\s+(?:pl|photoluminescence)\s*(?:peak|wavelength)\b",
    "has_ex": r"\bexcitation\b|\bexcited\s+at\b|\b(?:λ|lambda)\s*[_\s-]*ex\b|\bunder\s+(?:uv|laser)\s*\(?\d{2,4}\s*nm\)?",
    "has_qy": r"\bquantum\s+(?:yield|efficiency)\b|\bPLQY\b|\bQY\b|\bPhi\b|\bΦ\s*F\b",
    "has_lifetime": r"\blifetime\b|\bdecay(?:\s*time)?\b|τ|\btau\b",
    "exdep_pos": r"\bexcitation-?dependent\b|\bdependent\s+on\s+excitation\b|\bred-?shift(?:s|ed)?\b|\bblue-?shift(?:s|ed)?\b",
    "exdep_neg": r"\bexcitation-?independent\b|\bdoes\s+not\s+shift\b|\bremains\s+unchanged\s+with\s+excitation\b|\bindependent\s+of\s+excitation\b",
    "has_chiral": r"\bchiral(?:ity)?\b|\benantiomer(?:ic)?\b|\bL-[A-Za-z0-9\-]+?\s*CDs\b|\bD-[A-Za-z0-9\-]+?\s*CDs\b",
    "has_cpl_core": r"\bCPL\b|\bcircularly\s+polarized\s+luminescence\b|\bg[\s_\-]?lum\b|\bg-?factor\b",
    "has_cpl_lum": r"\bluminescen\w*\b|\bemission\b|\bPL\b",
}

#: What shows that a sentence has a unit.
UNIT_MARKS = {
    "nm": r"\d\s*nm(?:[^A-Za-z]|$)|nanomet(?:er|re)|\bnm\b",
    "μm": r"\d\s*(?:μm|um)(?:[^A-Za-z]|$)|\bum\b",
    "%": r"%|percent",
    "ns": r"\d\s*ns\b|\bns\b|nanosecond",
    "μs": r"\d\s*(?:μs|us)\b|\bus\b|microsecond",
    "ms": r"\d\s*ms\b|\bms\b|millisecond",
    "s": r"\b\d+(?:\.\d+)?\s*s(?:ec|econd)?s?\b|\bs\b|second",
}

#: Words that show a description of a synthesis, its circumstances, and a heading of its section.
ANCHOR = r"\b(?:synthesis|synthesi[sz]ed|preparation|prepared|fabrication|fabricated)\b|(?:experimental(?:\s+sections?)?)|(?:materials?\s*(?:and|&)\s*methods?)|(?:methodology)"
METHOD_CONTEXT = (
    r"\b(?:dissolved?|mixed|stirred?|heated?|hydrothermal|solvothermal|autoclave|microwave|calcined?|carboni[sz]ed|pyrolysis|annealed?|reflux(?:ed)?|centrifuged?|dialy[sz]ed|filtered?|filtration|washed?|"
    r"sonicat(?:ed|ion)|dropwise|react(?:ed|ion)|solution|precursor|ethanol|water|dmf|naoh|hcl|obtained?|yielded?|dispersed?|evaporated?|dried?)\b"
)
CONDITION_UNIT = r"\b\d+(?:\.\d+)?\s*(?:C|K|h|hr|hrs|hour|hours|min|mins|minutes|mL|uL|ul|L|g|mg|kg|M|mM|wt%|mol%|rpm|W)\b"
METHODS_HEADER = r"\b(?:experimental(?:\s+sections?)?|materials?\s*(?:and|&)\s*methods?|methods?|methodology|synthesis|preparation|fabrication)\b"

#: Where an article's tail begins: a heading, a mention anywhere, a word in the last quarter of the lines.
TAIL_HEADING = r"(?im)^\s*#{1,6}\s*(?:references|bibliography|acknowledg(?:e)?ments?|conflicts?\s*of\s*interest|competing\s+interests?|data\s+availability)\s*$"
TAIL_MENTION = r"(?i)\b(?:acknowledg(?:e)?ments?|conflicts?\s*of\s*interest|competing\s+interests?)\b"
TAIL_WORD = r"(?i)\b(?:acknowledg(?:e)?ments?|conflicts?\s*of\s*interest|competing\s+interests?|data\s+availability|references?|bibliography)\b"

#: The properties in their canonical order; those with numbers; those that may keep two values.
PROPERTY_ORDER = ["Ex", "Em", "QY", "lifetime", "ExDep", "Chiral", "CPL"]
NUMERIC_PROPERTIES = ["Ex", "Em", "QY", "lifetime"]
#: A number with a unit that fits the property; the number is the group.
NUMERIC_PATTERNS = {"Ex": r"(\d+(?:\.\d+)?)\s*nm\b", "Em": r"(\d+(?:\.\d+)?)\s*nm\b", "QY": r"(\d+(?:\.\d+)?)\s*%", "lifetime": r"(\d+(?:\.\d+)?)\s*(?:fs|ps|ns|us|ms|s)\b"}
UNIQUE_PROPERTIES = ["Ex", "Em", "ExDep", "Chiral", "CPL"]
PAIRED_PROPERTIES = ["QY", "lifetime"]
#: The columns of the synthesis table.
TABLE_COLUMNS = ["CDs_Naming_in_Paper", "Synthesis_Method", "Temperature", "Time", "Microwave_Power", "Precursor", "Precursor_Amount", "Solvent", "Solvent_Volume", "Purification"]
