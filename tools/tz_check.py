"""Run every query under another session time zone against its oracle (sf0.001).

usage: python tools/tz_check.py [zone]   (default America/Los_Angeles)
"""
import sys, decimal
sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])
from pyspark.sql import SparkSession
import duckdb
tz = sys.argv[1] if len(sys.argv) > 1 else "America/Los_Angeles"
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", tz).getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
from casebook.plans import all_oracles, all_queries
from casebook.sources.tables import TABLES
d = "/root/testdata/sf0.001"
con = duckdb.connect()
for t in TABLES:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
def norm(v):
    if v is None: return None
    if isinstance(v, float): return f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal): return f"{round(float(v), 6):.6f}"
    if hasattr(v, "isoformat"): return v.isoformat()
    if isinstance(v, (list, tuple)): return tuple(norm(x) for x in v)
    return v
def canon(cols, rs):
    o = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in o) for r in rs), key=repr)
bad = []
qs, sq = all_queries(), all_oracles()
for n in sorted(qs):
    df = qs[n](spark, d)
    res = con.execute(sq[n])
    if canon(df.columns, [tuple(r) for r in df.collect()]) != canon([x[0] for x in res.description], res.fetchall()):
        bad.append(n)
print(tz, "mismatches:", bad, "of", len(qs))
