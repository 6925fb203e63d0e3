import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "ru", "sa", "to", "vi") for b in ("dan", "fel", "gor", "hin", "jas", "kel", "mor", "pen", "rit", "sul")]


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text), in several partitions, with columns whose names operators use inside."""

    def build(rows, parts=3):
        wide = [(i, t, "x", "y", 1, True, "z") for i, t in rows]
        df = spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n long, kept boolean, digest string")
        return df.repartition(parts) if parts else df

    return build


@pytest.fixture(scope="session")
def corpus():
    """Seeded texts with exact copies, near copies, shared passages, nulls, blanks, repeated rows and one very long text."""
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    passage = say(60)
    texts = [say(rng.randint(1, 120)) for _ in range(60)]
    texts += [texts[3]] * 12 + [texts[7].upper()] + [texts[9] + " ", ""] + ["", "   ", None, "\n\t"]
    for base in (texts[5] + " " + say(60), say(90)):
        for _ in range(10):
            w = base.split()
            for _ in range(rng.randint(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            texts.append(" ".join(w))
    texts += [say(20) + " " + passage + " " + say(20) for _ in range(8)] + [passage * 2, say(6000)]
    small = say(7).split()
    texts += [" ".join(small), " ".join(small + ["end"]), " ".join(small[1:]), " ".join(["a", *small]), "one", "one", "two words"]
    return [*enumerate(texts)]
