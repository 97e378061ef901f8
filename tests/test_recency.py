from strata.plans import registry
from tests.oracle import compare, connection

SF = "/root/testdata/sf0.001"


def test_registered_queries_match_their_sql(spark):
    con = connection(SF)
    for name, q in registry.QUERIES.items():
        if name in registry.ORACLE:
            compare(q(spark, SF), registry.ORACLE[name], con)
