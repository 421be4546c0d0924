"""Hand-written music-store data for the native tables."""

from __future__ import annotations

from datetime import date

from tallykeep.sources.native import native_model

# TrackId: (AlbumId, GenreId)
TRACKS = {1: (1, 1), 2: (1, 1), 3: (2, 2), 4: (2, 2), 5: (3, 3), 6: (None, 1), 7: (3, None)}
ALBUMS = {1: 1, 2: 2, 3: 3}
ARTISTS = {1: "Ann", 2: "Bob", 3: "Cid", 4: "Dee"}
# Two ids share the name Rock.
GENRES = {1: "Rock", 2: "Jazz", 3: "Rock", 4: "Opera"}


def day(text: str) -> date:
    return date.fromisoformat(text)


def store(spark, invoices, lines, tracks=None, price="0.99"):
    """``invoices``: (InvoiceId, CustomerId, date text, country); ``lines``: (InvoiceId, TrackId, Quantity)."""
    tracks = TRACKS if tracks is None else tracks

    def frame(rows, schema):
        return spark.createDataFrame(list(rows), schema).coalesce(1)

    return native_model(
        spark,
        invoice=frame(
            [(i, c, day(d), place) for i, c, d, place in invoices],
            "InvoiceId int, CustomerId int, InvoiceDate date, BillingCountry string",
        ),
        invoice_line=frame(
            [(i, t, price, q) for i, t, q in lines],
            "InvoiceId int, TrackId int, UnitPrice string, Quantity int",
        ),
        track=frame(
            [(t, a, g) for t, (a, g) in tracks.items()], "TrackId int, AlbumId int, GenreId int"
        ),
        album=frame(ALBUMS.items(), "AlbumId int, ArtistId int"),
        artist=frame(ARTISTS.items(), "ArtistId int, Name string"),
        genre=frame(GENRES.items(), "GenreId int, Name string"),
    )


def one_line_each(invoices, track=1):
    """A line of one unit for every invoice."""
    return [(invoice[0], track, 1) for invoice in invoices]


def dicts(df):
    return [row.asDict() for row in df.collect()]


def only(df):
    rows = dicts(df)
    assert len(rows) == 1
    return rows[0]


def keyed(df, *keys):
    """Rows by one key column, or by a tuple of several."""
    rows = {}
    for row in dicts(df):
        key = row[keys[0]] if len(keys) == 1 else tuple(row[k] for k in keys)
        assert key not in rows
        rows[key] = row
    return rows
