import datetime as dt

SF_SMALL = "/root/testdata/sf0.001"


def canon(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return f"{v:.6f}"
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def canon_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return canon_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return canon_rows(cols, cur.fetchall())
