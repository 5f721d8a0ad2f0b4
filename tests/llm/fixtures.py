"""Small tables with every awkward case, and plain versions of the operators."""

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
CLASHES = ("row", "size", "key", "h", "group", "id", "n", "line", "next", "part", "members", "copies", "score", "kept", "label")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


def prose(rng, n):
    return " ".join("".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(2, 8))) for _ in range(n))


def rows(seed=5):
    rng = random.Random(seed)
    shared = prose(rng, 60)
    texts = [prose(rng, rng.choice([3, 20, 80, 200])) for _ in range(30)]
    texts += [texts[3], texts[3], texts[4] + " tail", shared, "x " + shared, prose(rng, 40) + "\n" + shared + "\n" + prose(rng, 10),
              "word " * 120, "", " \t\n ", None, "é" * 50 + " ñandú\n\nße 漢字", prose(rng, 6000), "a\x00b c\x1fd", "one two three"]
    changed = texts[5].split()
    if len(changed) > 30:
        changed[10] = "changed"
    texts.append(" ".join(changed))
    out = [(i * 7 - 20, t, "en", rng.choice(["src0", "src0", "src1", "ß", None]), len(t) if t else None) for i, t in enumerate(texts)]
    out += [out[3], out[3], (None, "no id here", None, None, None), (None, None, None, "src9", 3)]
    return [r + ("clash",) * len(CLASHES) for r in out]


def documents(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def words(text):
    return WORDS.findall(text or "")


def components(nodes, links):
    up = {x: x for x in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}
