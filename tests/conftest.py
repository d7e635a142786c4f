import sys
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from encore.schemas import STAGING_EVENTS, STAGING_SONGS  # noqa: E402
from encore.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        4,
        **{
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(shared),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def make_events(spark):
    """Staging events from partial dicts; the rest is a NextSong event of user 1."""
    defaults = dict(
        artist="A", auth="Logged In", firstname="Ann", gender="F", iteminsession=0,
        lastname="Lee", length=Decimal("1.00000"), level="free", location="Here", method="PUT",
        page="NextSong", registration=Decimal(1), sessionid=1, song="S", status=200, ts=10,
        useragent="agent", userid=1,
    )

    def make(*rows):
        data = [tuple({**defaults, **row}[n] for n in STAGING_EVENTS.names) for row in rows]
        return spark.createDataFrame(data, STAGING_EVENTS.schema)

    return make


@pytest.fixture
def make_songs(spark):
    """Staging songs from partial dicts; the rest is song S1 of artist A1, named A."""
    defaults = dict(
        num_songs=1, artist_id="A1", artist_latitude=None, artist_longitude=None,
        artist_location="There", artist_name="A", song_id="S1", title="S",
        duration=Decimal("1.00000"), year=2000,
    )

    def make(*rows):
        data = [tuple({**defaults, **row}[n] for n in STAGING_SONGS.names) for row in rows]
        return spark.createDataFrame(data, STAGING_SONGS.schema)

    return make


def rows(df, *columns):
    """Rows as sorted tuples, NULLs first."""
    picked = df.select(*columns) if columns else df
    return sorted(map(tuple, picked.collect()), key=lambda r: [(v is not None, v) for v in r])
