"""Documents for edge cases: nulls, empty and very long texts, ties, repeated rows, clashing column names."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, KEY string, nth int, keep_id int, _fp string"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]

BODY = "The quick brown fox jumps over the lazy dog, while seven wise owls watch from an old oak tree near the river bank"
FRENCH = "Le renard brun saute par dessus le chien paresseux pendant que sept hiboux regardent depuis un vieux chêne près de la rivière"
TEXTS = [
    None,
    "",
    " ",
    "\n\t ",
    "a",
    "...!!!",
    "12345 67",
    BODY,
    BODY,
    BODY + " today",
    FRENCH,
    FRENCH.upper(),
    BODY.upper(),
    "word " * 30000,
    "x" * 20000,
    "日本語のテキスト" * 50,
    "emoji 🎉🎉 \x00 nul \x1c sep   spaces\r\n\r\n",
    "Released under the MIT License.\nSee the Apache\nLicense and the general public license; mit license mit license",
    "Licensed under CC BY-NC 4.0.",
    "it's we're they'll I'd 's 'S ''s",
]


def rows():
    out = [(i, t, ("fr" if t and "renard" in t.lower() else "en") if t else None, "s", len(t or ""), "x", "y", i, None, "z") for i, t in enumerate(TEXTS)]
    out += [out[7], out[7], out[1], (None, BODY, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None), (500, BODY + " again", "en", "s", 1, None, None, None, None, None), (500, FRENCH + " encore", "fr", "s", 1, None, None, None, None, None)]
    return out


VECTORS = "vec_id long, embedding array<float>, label int, key string, vector string, CLUSTER int, distance long"


def vectors():
    """Vectors of 64 components among which some are null, too short, not finite, equal, or have equal or null ids."""
    out = []
    for i in range(150):
        out.append((i, [((i * 37 + d * (i % 7 + 1) * 11) % 101 - 50) / (64 if i % 3 else 1) for d in range(64)]))
    same = [0.5] * 64
    out += [(1000 + i, same) for i in range(60)] + [(7, same), (7, same), (7, out[8][1]), (None, out[9][1]), (None, same)]
    out += [(2000, None), (2001, []), (2002, [0.25] * 63), (2003, [0.25] * 65), (2004, [None] + [0.25] * 63), (2005, [float("nan")] * 64), (2006, [float("-inf")] + [0.0] * 63)]
    return [(i, v, None, "k", None, 1, 2) for i, v in out]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def write_tables(spark, path, docs=None, benchmark=None, pages=None):
    """A folder of tables as the queries read them."""
    (docs if docs is not None else documents(spark)).write.parquet(f"{path}/documents.parquet")
    (benchmark if benchmark is not None else spark.createDataFrame([(1, " ".join(BODY.split()[2:16])), (2, "lazy dog"), (3, None), (4, "..."), (2, "old oak"), (None, "hiboux regardent")], "item_id long, text string")).write.parquet(f"{path}/benchmark.parquet")
    (pages if pages is not None else spark.createDataFrame(PAGES, "page_id long, url string, html string")).write.parquet(f"{path}/pages.parquet")
    spark.createDataFrame(vectors() if docs is None else [], VECTORS).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


PAGES = [
    (1, "https://www.example.com/en/1?x=1", "<html><head><title>A &amp; B</title><style>p{}</style></head><body><h1>Hi</h1><p>one<br>two<!-- no --></p><script>var t='</p>';</script><a href='/x?a=1&amp;b=2'>l</a></body></html>"),
    (2, "http://blog.EXAMPLE.com/en/2", ""),
    (3, "http://a.example.net/es/3#t", None),
    (4, "http://xnet/es/3", "<p>x"),
    (5, None, None),
    (6, "no scheme", "plain < text > & more &lt;b&gt;"),
    (7, "http://spam-farm.example.org/", "x"),
    (8, "http://notspam-farming.example.org/a", "x"),
    (9, "http://foo.com", "x"),
    (10, "http://foo.com/", "x"),
    (11, "://net/fr/", "x"),
    (12, "http://a.net/fr?x", "x"),
    (13, "http://a.net:80/fr/", "x"),
    (1, "https://www.example.com/en/1?x=1", "again"),
    (14, "http://example.com/en/?q=://net/es/", "x"),
    (15, "http://u@cheap-pills.example.org/x://y", "x"),
]
