import random
import re
from collections import Counter

from tallybook.llm.quality import judged

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count, repeated = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            repeated.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def test_against_brute_force(documents, odd):
    random.seed(9)
    rows = list(odd)
    for i in range(150):
        words = random.choices(["the", "a", "b#", "é", "|", "long-word", "&&"], k=random.randint(0, 60))
        rows.append((100 + i, "".join(w + random.choice([" ", "\n", "\t", "  ", "\x0b\x0c\r", "\x85"]) for w in words)))
    rows.append((99, "a b c d e f g h " * 40))
    found = judged(documents(rows)).collect()
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in found) == Counter((r[0], *brute(r[1])) for r in rows)
    assert not any(r.kept and r.base_failed for r in found)


def test_verdict(documents):
    random.seed(10)
    clean = " ".join(random.choices("the house of many rooms and a garden that was green for years".split(), k=80))
    rows = [(1, clean), (2, clean.replace(" ", "### ")), (3, clean.upper() + "!!"), (4, "qzx wvut mnbv plk " * 30), (5, "\n".join([clean, clean]))]
    kept = {r.doc_id: r.kept for r in judged(documents(rows)).collect()}
    assert kept[1] and not any(kept[i] for i in (2, 3, 4, 5))


def test_no_python(documents):
    plan = judged(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty_table(documents):
    assert judged(documents([])).collect() == []
