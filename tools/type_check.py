"""Compare result column types of queries() and oracle_sql() (sf0.001)."""
import sys
sys.path.insert(0, "/root/repo")
import duckdb
from casebook.plans import all_oracles, all_queries
from casebook.session import build_session
from casebook.sources.tables import TABLES
d = "/root/testdata/sf0.001"
sp = build_session("local[8]", shuffle_partitions=8)
con = duckdb.connect()
for t in TABLES:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
M = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE", "StringType()": "VARCHAR",
     "DateType()": "DATE", "TimestampNTZType()": "TIMESTAMP", "BooleanType()": "BOOLEAN",
     "ShortType()": "SMALLINT", "FloatType()": "FLOAT", "ByteType()": "TINYINT"}
qs, sqls = all_queries(), all_oracles()
bad = 0
for n in sorted(qs):
    df = qs[n](sp, d)
    st = {f.name: f.dataType for f in df.schema.fields}
    rel = con.sql(sqls[n])
    dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for c, t in st.items():
        s = str(t)
        if s.startswith("DecimalType"):
            s = "DECIMAL" + s[len("DecimalType"):]
        else:
            s = M.get(s, s)
        if s.replace(" ", "") != dt.get(c, "?").replace(" ", ""):
            bad += 1
            print(f"{n}.{c}: spark {s} duck {dt.get(c)}")
print("mismatched columns:", bad)
