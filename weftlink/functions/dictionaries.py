"""Word lists of the text normalizers. Results depend on every entry."""

# fixed values: spellings of legal forms and their canonical forms
LEGAL_FORMS = {
    "inc": "inc", "incorporated": "inc", "llc": "llc", "corp": "corp", "corporation": "corp",
    "co": "co", "company": "co", "ltd": "ltd", "limited": "ltd", "pvt": "pvt", "private": "pvt",
    "llp": "llp", "lp": "lp", "plc": "plc", "pllc": "pllc", "opc": "opc", "gmbh": "gmbh",
    "sarl": "sarl", "sas": "sas", "sasu": "sasu", "sa": "sa", "eurl": "eurl", "sci": "sci", "snc": "snc",
}
# fixed values: abbreviations in names
NAME_WORDS = {
    "intl": "international", "mfg": "manufacturing", "mfrs": "manufacturers", "svc": "service",
    "svcs": "services", "assoc": "associates", "assn": "association", "bros": "brothers",
    "ctr": "center", "centre": "center", "dept": "department", "natl": "national",
    "mgmt": "management", "grp": "group", "sys": "systems", "engg": "engineering",
    "inds": "industries", "hosp": "hospital", "univ": "university", "trdg": "trading",
}
# fixed values: abbreviations in addresses
ADDRESS_WORDS = {
    "st": "street", "str": "street", "rd": "road", "ave": "avenue", "av": "avenue",
    "blvd": "boulevard", "bd": "boulevard", "dr": "drive", "ln": "lane", "ct": "court",
    "pl": "place", "hwy": "highway", "pkwy": "parkway", "sq": "square", "ter": "terrace",
    "cir": "circle", "trl": "trail", "apt": "apartment", "ste": "suite", "fl": "floor",
    "bldg": "building", "n": "north", "s": "south", "e": "east", "w": "west",
    "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest",
    "nr": "near", "opp": "opposite", "sec": "sector", "ph": "phase", "extn": "extension",
    "ext": "extension", "ngr": "nagar", "mkt": "market", "dist": "district",
    "r": "rue", "rte": "route", "chem": "chemin", "imp": "impasse", "fbg": "faubourg",
}
# fixed values: words that are no street's own name
STREET_TYPES = [
    "street", "road", "avenue", "boulevard", "drive", "lane", "court", "place", "highway",
    "parkway", "square", "terrace", "circle", "trail", "way", "rue", "route", "chemin",
    "impasse", "allee", "marg", "path", "sector", "nagar", "colony", "block", "main", "cross",
]
OTHER_WORDS = [
    "door", "no", "number", "plot", "flat", "house", "shop", "unit", "suite", "apartment",
    "floor", "building", "near", "opposite", "bis", "ter", "po", "box", "north", "south",
    "east", "west", "northeast", "northwest", "southeast", "southwest",
]
# fixed values: postal codes of states
STATES = {
    "al": "alabama", "ak": "alaska", "az": "arizona", "ar": "arkansas", "ca": "california",
    "co": "colorado", "ct": "connecticut", "de": "delaware", "fl": "florida", "ga": "georgia",
    "hi": "hawaii", "id": "idaho", "il": "illinois", "in": "indiana", "ia": "iowa",
    "ks": "kansas", "ky": "kentucky", "la": "louisiana", "me": "maine", "md": "maryland",
    "ma": "massachusetts", "mi": "michigan", "mn": "minnesota", "ms": "mississippi",
    "mo": "missouri", "mt": "montana", "ne": "nebraska", "nv": "nevada", "nh": "new hampshire",
    "nj": "new jersey", "nm": "new mexico", "ny": "new york", "nc": "north carolina",
    "nd": "north dakota", "oh": "ohio", "ok": "oklahoma", "or": "oregon", "pa": "pennsylvania",
    "ri": "rhode island", "sc": "south carolina", "sd": "south dakota", "tn": "tennessee",
    "tx": "texas", "ut": "utah", "vt": "vermont", "va": "virginia", "wa": "washington",
    "wv": "west virginia", "wi": "wisconsin", "wy": "wyoming", "dc": "district of columbia",
}
# fixed values: words dropped at the ends of names, and stand-ins for a missing address
EDGE_WORDS = ["the", "and", "of"]
PLACEHOLDERS = ["null", "na", "none", "nil"]
# fixed values: Unicode blocks of scripts, first and last code point
SCRIPTS = [
    ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("gurmukhi", 0x0A00, 0x0A7F),
    ("gujarati", 0x0A80, 0x0AFF), ("oriya", 0x0B00, 0x0B7F), ("tamil", 0x0B80, 0x0BFF),
    ("telugu", 0x0C00, 0x0C7F), ("kannada", 0x0C80, 0x0CFF), ("malayalam", 0x0D00, 0x0D7F),
]
