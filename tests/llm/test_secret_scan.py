import random
import re
import string
from collections import Counter
from math import log

from pyspark.sql import functions as F

from tallybook.llm.secret_scan import ALPHABET, ASSIGN, BASE, extracted, ratio, scan, trained, written

KINDS = ["assign", "access", "hex"]


def brute(text):
    out = []
    for number, (_, pattern, group, least) in enumerate(BASE):
        out += [(m.start(), number, m.end()) for m in re.finditer(pattern, text, re.A) if len(m[group]) >= least]
    return sorted(out)


def test_pattern_is_the_same_in_both_languages():
    assert re.compile(ASSIGN, re.A).search("my Api_Key'  =  \"abc/def.1\"").groups() == ("Api_Key", "abc/def.1")


def test_base_spans_against_the_plain_patterns(documents, staging):
    random.seed(17)
    pieces = ["password", "PASSWD", "secret", "token", "api_key", "apikey", "=", ":", " ", '"', "'", "abc", "x1y2z3", "AKIA", "A1B2C3D4E5F6G7H8",
              "0123456789abcdef", "deadbeef", "é", "\n", "k", "AKIAKIA", "ff"]
    rows = [(i, "".join(random.choices(pieces, k=random.randint(0, 25)))) for i in range(800)]
    found = scan(documents(rows), staging)
    base = written(F.filter("spans", lambda s: s["kind"] < 3)).alias("base")
    texts = dict(rows)
    for r in found.select("*", base).collect():
        want = brute(texts[r.doc_id])
        assert r.base == ",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e in want), repr(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in want) for i in range(3)]
        for s in r.spans:
            if s.kind == 3:
                assert all(s.end <= a or s.start >= e for a, _, e in want)


def test_random_strings_stand_out_from_identifiers(documents, staging):
    random.seed(18)
    names = "read write file buffer socket handler request response value index count user session config parse render update cache".split()
    mixed, planted, rows = string.ascii_letters + string.digits, {}, []
    for i in range(400):
        words = ["_".join(random.choices(names, k=4)) if random.random() < 0.3 else random.choice(names) for _ in range(60)]
        if i % 4 == 0:
            planted[i] = "".join(random.choices(mixed, k=32))
            words.insert(30, planted[i])
        if i % 10 == 0:
            words.insert(5, f'token = "{"".join(random.choices(mixed, k=40))}"')
        rows.append((i, " ".join(words)))
    hit, wrong = 0, 0
    texts = dict(rows)
    for r in scan(documents(rows), staging).collect():
        found = {texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == 3}
        hit += planted.get(r.doc_id) in found
        wrong += len(found - {planted.get(r.doc_id)})
    assert hit >= 0.95 * len(planted) and wrong <= 2


def test_short_random_strings_are_found_and_numbers_are_none(documents, staging):
    """Strings of 12 to 19 characters, which no base pattern looks for, among words of the same length."""
    random.seed(21)
    names = "readbuffer writebuffer requesthandler responsevalue sessioncounter configparser renderindex updatecache".split()
    mixed, planted, rows = string.ascii_letters + string.digits, {}, []
    for i in range(500):
        words = [random.choice(names) + random.choice(["", "s", "_list", "Thing", "er"]) for _ in range(40)]
        if i % 5 == 0:
            planted[i] = "".join(random.choices(mixed, k=random.randint(12, 19)))
            words.insert(20, planted[i])
        if i % 10 == 3:
            words.insert(5, f'token = "{"".join(random.choices(mixed, k=40))}"')
        words.append(str(random.randint(10**15, 10**16)))
        rows.append((i, " ".join(words)))
    texts, hit, wrong = dict(rows), 0, 0
    for r in scan(documents(rows), staging).collect():
        found = {texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == 3}
        hit += planted.get(r.doc_id) in found
        wrong += len(found - {planted.get(r.doc_id)})
    assert hit >= 0.95 * len(planted) and wrong == 0


def test_ratio_against_brute_force(spark, documents, staging):
    random.seed(22)
    rows = [(i, f'token={"".join(random.choices("abcXYZ019", k=30))} ' + " ".join(random.choices(["listofthings", "otherwords", "ab1"], k=9))) for i in range(60)]
    found = extracted(documents(rows))
    table = trained(found, documents(rows))
    strings = {r.value for r in found.where("kind = 0").select("value").collect()}
    words = [w for _, t in rows for w in re.findall("[A-Za-z0-9+/_=-]{8,}", t) if w not in strings and not re.search("[0-9a-f]{24}", w)]
    words = [w for w in words if words.count(w) > 1]
    counts = [Counter(x[i : i + 2] for x in xs for i in range(len(x) - 1)) for xs in (strings, words)]

    def chance(k, pair):
        second = sum(n for p, n in counts[k].items() if p[1] == pair[1])
        share = (1 + second) / (len(ALPHABET) + sum(counts[k].values()))
        return (counts[k][pair] + 10 * share) / (sum(n for p, n in counts[k].items() if p[0] == pair[0]) + 10)

    values = ["listofthings", "aX9Zb01caY1c", "=+/_-abc0Z9=", "zzzzzzzzzzzz"]
    frame = spark.createDataFrame([(v,) for v in values], "value string")
    for row in frame.select("value", ratio(F.col("value"), table).alias("ratio")).collect():
        want = sum(log(chance(0, p) / chance(1, p)) for p in (row.value[i : i + 2] for i in range(len(row.value) - 1)))
        assert abs(row.ratio - want) < 1e-9


def test_odd_rows(documents, staging, odd):
    rows = [*odd, (20, "secret: abcdef"), (20, "secret: abcdef")]
    found = scan(documents(rows), staging).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    assert sum(r.n_assign for r in found) == 2


def test_no_python_and_empty_table(documents, staging):
    assert not re.search("Python|Arrow|Pandas", extracted(documents([]))._jdf.queryExecution().executedPlan().toString())
    assert scan(documents([]), staging).collect() == []
