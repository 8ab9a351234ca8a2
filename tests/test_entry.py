"""Driver contract: import without a session, entry() on sf0.001, oracle keys are query keys."""

import subprocess
import sys

from conftest import ROOT


def _queries_without(*missing):
    code = ("import sys; sys.path.insert(0, %r); sys.modules.update({m: None for m in %r}); import __spark_entry__ as E; "
            "q, o = E.queries(), E.oracle_sql(); assert set(o) <= set(q); print(len(q))" % (ROOT, missing))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    return int(out.stdout.strip())


def test_import_without_spark():
    assert _queries_without() >= 60


def test_queries_without_the_training_data_subpackage():
    assert 60 <= _queries_without("vaultline.llm") <= _queries_without()


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["customer_id", "account_id", "original_balance", "interest_rate", "annual_interest",
                          "new_balance"]
    assert df.count() > 0
