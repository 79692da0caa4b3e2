"""Made-up texts for the tests."""

import random


def some_texts(seed, n=60, words=12, least=0, most=60):
    """Texts of few words with copied passages."""
    draw = random.Random(seed)
    vocabulary = [draw.choice("abcdé") * draw.randint(1, 3) + str(i) for i in range(words)]
    texts = []
    for _ in range(n):
        text = [draw.choice(vocabulary) for _ in range(draw.randint(least, most))]
        for _ in range(draw.randint(0, 2)):
            if texts:
                other = draw.choice(texts)
                a = draw.randint(0, len(other))
                text[draw.randint(0, len(text)) : 0] = other[a : a + draw.randint(1, 40)]
        texts.append(text)
    return [draw.choice([" ", "\n", "  "]).join(t) for t in texts]
