from concurrent.futures import ThreadPoolExecutor

import pytest

from flowlens import schema as S
from flowlens.sources.claims import claim_files, claimed_sessions

from .helpers import session_row, sessions_df


def _files(spark, workdir, n, first=0):
    for i in range(first, first + n):
        sessions_df(spark, [session_row(i)]).coalesce(1).write.parquet(f"{workdir}/in/f{i:02d}")


def _ids(df):
    return sorted(r[0] for r in df.select(S.SESSION_ID).collect())


def test_concurrent_runs_share_no_file(spark, workdir):
    _files(spark, workdir, 9)
    with ThreadPoolExecutor(4) as pool:
        claims = list(pool.map(lambda _: claim_files(spark, f"{workdir}/in", f"{workdir}/ledger", max_files=3), range(4)))
    files = [f for c in claims for f in c.files]
    assert len(files) == 9 == len(set(files)) and sorted(len(c.files) for c in claims) == [0, 3, 3, 3]


def test_a_failed_runs_files_are_free_again(spark, workdir):
    _files(spark, workdir, 3)
    with pytest.raises(ValueError):
        with claimed_sessions(spark, f"{workdir}/in", f"{workdir}/ledger") as rows:
            assert _ids(rows) == [0, 1, 2]
            raise ValueError
    with claimed_sessions(spark, f"{workdir}/in", f"{workdir}/ledger", max_files=2) as rows:
        assert _ids(rows) == [0, 1]
    _files(spark, workdir, 1, first=5)
    for want in ([2, 5], []):
        with claimed_sessions(spark, f"{workdir}/in", f"{workdir}/ledger") as rows:
            assert _ids(rows) == want


def test_an_expired_run_cannot_finish(spark, workdir):
    _files(spark, workdir, 2)
    slow = claim_files(spark, f"{workdir}/in", f"{workdir}/ledger", lease_ms=1000, now_ms=0)
    assert claim_files(spark, f"{workdir}/in", f"{workdir}/ledger", now_ms=900).files == []
    other = claim_files(spark, f"{workdir}/in", f"{workdir}/ledger", now_ms=1001)
    assert other.files == slow.files
    with pytest.raises(TimeoutError):
        slow.finish()
    other.finish()
    other.finish()  # again: no harm
    assert claim_files(spark, f"{workdir}/in", f"{workdir}/ledger").files == []
