import random
import re
from collections import Counter

import pytest
from llm_rows import awkward, prose, table

from lakeshelf.llm import licenses


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def runs(w):
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def brute(rows):
    """(document, license) of templates of which a window holds the share of shingles."""
    out = Counter()
    for doc, text, _ in rows:
        held, best = runs(words(text)), {}
        for name, template in licenses.TEMPLATES:
            wanted, n = set(runs(words(template))), len(words(template))
            step = licenses.stride(n)
            for s in range(0, len(held), step):
                share = len(wanted & set(held[s : s + n + step - 4])) / len(wanted)
                if share >= licenses.SHARE:
                    best[name] = max(best.get(name, (0, 0, 0)), (share, -s, n))
        places = {name: (share, -s, n + licenses.stride(n)) for name, (share, s, n) in best.items()}
        for name, (share, s, n) in places.items():
            if not any(t < s + n and s < t + m and other > share for other, t, m in places.values()):
                out[(doc, name, round(share, 9), s, n)] += 1
    return out


def rows():
    draw, out = random.Random(8), awkward()
    for i, (_, template) in enumerate(licenses.TEMPLATES * 3):
        inner = template.split()
        if i >= len(licenses.TEMPLATES):
            inner[draw.randrange(len(inner))] = "changed"
        if i >= 2 * len(licenses.TEMPLATES):
            inner[draw.randrange(len(inner))] = "again"
        out.append((100 + i, prose(i, draw.randint(0, 60)) + "\n// " + " ".join(inner) + "\n" + prose(i + 99, draw.randint(0, 200)), "s"))
    out.append((900, licenses.TEMPLATES[0][1] + " " + prose(1, 300) + licenses.TEMPLATES[4][1].upper(), "s"))
    out.append((901, "the license of a licensed work, and the permission and redistribution, was mozilla conditions", "s"))
    return out


def test_matches_against_brute_force(spark):
    found = licenses.license_matches(spark, table(spark, rows(), ["row", "n", "held", "band"])).collect()
    got = Counter((r.doc_id, r.license, round(r.share, 9), r.start_word, r.n_words) for r in found)
    assert got == brute(rows())
    assert len(got) >= 15


def test_bands_leave_few_misses():
    for n in (5, 8, 20, 100):
        window = n + licenses.stride(n) - 4
        least = licenses.SHARE * (n - 4) / (window + (1 - licenses.SHARE) * (n - 4))
        assert (1 - least) ** licenses.bands(n, licenses.SHARE, licenses.MISS) <= licenses.MISS


def test_key_words_stand_in_enough_shingles():
    for _, template in licenses.TEMPLATES:
        w = words(template)
        held = set(runs(w))
        assert sum(licenses.key_word(w, licenses.SHARE) in r for r in held) > 0.2 * len(held)


def test_no_python_in_the_plan(spark):
    plan = licenses.license_matches(spark, table(spark, awkward()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_short_templates_are_refused(spark):
    with pytest.raises(ValueError):
        licenses.license_matches(spark, table(spark, awkward()), templates=[("X", "too short")])


def test_empty_table(spark):
    assert licenses.license_matches(spark, table(spark, [])).count() == 0
