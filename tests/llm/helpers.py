"""Fixtures and plain versions to compare the operators with."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def base_texts():
    prose = " ".join(f"word{i % 97}x{i % 13} and" for i in range(400))
    near = prose.replace("word5x5", "changed")
    return [
        prose, near, prose, "", None, "   \n\t ", "one", "one two three four", "one two three four", "short text of five words",
        "A b C d e F g", "a B c D e f G", "line one is here\nline one is here\n\nline two\nline one is here", "MIT License", "x" * 3000,
        "naïve café … don't I'LL a's.b'T 3.14 <|startoftext|> end", "J̌ İstanbul ΣΑΣ ﬁ １２\x85\x1c ok", "go " * 5000, near + " tail", prose[: len(prose) // 2],
        "#### $$$$ | | | %%% &&& ***", "you are an 1d10t and a l o s e r", "tie tie tie tie",
    ]


def documents(spark, texts=None, extra=True):
    """The texts as a documents table, with a repeated row and a column whose name clashes."""
    texts = base_texts() if texts is None else texts
    rows = [(i * 3, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", "1 as id", "2 as length", "'x' as key", "3 as size", "4 as component") if extra else df


def words(text):
    return WORD.findall(text or "")


def shingles(text, width=5):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
