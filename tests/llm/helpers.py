"""Small documents with every awkward case, and plain re-implementations."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string"


def words(text):
    return WORD.findall(text or "")


def documents(seed=1, passage=70):
    """(doc_id, text, lang, source, n_chars, row): copies, near copies, shared passages, nulls, repeated rows; ``row``
    is an extra column with a name that operators use themselves."""
    r = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)] + ["é", "日本", "A", "b c", "x y"]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    shared = text(passage)
    out = [(10, None), (11, ""), (12, " \n\t "), (13, "one"), (14, "one two"), (15, text(49)), (16, text(50)), (17, text(3000))]
    for i in range(20, 30):
        out.append((i, text(r.randint(0, 40)) + "\n" + shared + "\t" + text(r.randint(0, 120))))
    base = text(300)
    for i in range(30, 36):
        w = base.split(" ")
        for _ in range(i - 30):
            w[r.randrange(len(w))] = "changed"
        out.append((i, " ".join(w)))
    out += [(40, base), (41, base), (42, base.upper()), (42, base), (43, shared + " " + shared), (44, shared)]
    out += [(44, shared), (None, base), (None, None), (5, shared[: len(shared) // 2]), (50, "z " * 200)]
    r.shuffle(out)
    return [(i, t, r.choice(["en", "de", None]), r.choice(["src0", "src1", "src7", None]), len(t or ""), "extra") for i, t in out]


def groups(links, members):
    """Smallest reachable member of each member."""
    top = {m: m for m in members}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            top[max(a, b)] = min(a, b)
    return {m: find(m) for m in members}
