"""Small document tables with the awkward cases, and an oracle runner."""

import duckdb

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EDGES = [None, "", " \n\t ", "one", "One two", "a b c", "x" * 3000, "é" * 150, "the same words " * 200, "1234 5678 !!"]


def documents(spark, texts, first=0, lang="en"):
    rows = [(first + i, t, None if i % 7 == 3 else lang, None if i % 5 == 4 else f"s{i % 2}", len(t) if t else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def plain(text):
    """Lower-cased words as the operators see them."""
    return (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def norm(v):
        return round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def oracle(sql, folder=SF, **tables):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        if t in tables:
            con.register(f"_{t}", tables[t])
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM _{t}")
        else:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    cur = con.execute(sql)
    return as_rows([c[0] for c in cur.description], cur.fetchall())


def saved(spark, tmp_dir, **tables):
    for name, df in tables.items():
        df.coalesce(2).write.parquet(f"{tmp_dir}/{name}.parquet")
    return tmp_dir
