"""Model over the native tables of a music store.

Invoice(InvoiceId, CustomerId, InvoiceDate, BillingCountry)
InvoiceLine(InvoiceId, TrackId, UnitPrice, Quantity)
Track(TrackId, AlbumId, GenreId), Album(AlbumId, ArtistId)
Artist(ArtistId, Name), Genre(GenreId, Name)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallykeep.functions.measures import cents_of, whole
from tallykeep.model import SalesModel


def native_model(
    spark: SparkSession,
    invoice: DataFrame,
    invoice_line: DataFrame,
    track: DataFrame,
    album: DataFrame,
    artist: DataFrame,
    genre: DataFrame,
) -> SalesModel:
    """A track without a genre or without an artist keeps NULL for the missing one.

    Fractional quantities and unit prices with fractions of a cent are refused when read.
    """
    billed = invoice.select(
        F.col("InvoiceId").cast("bigint"),
        F.col("CustomerId").cast("bigint"),
        F.col("InvoiceDate").cast("date").alias("dt"),
        F.col("BillingCountry").alias("country"),
    )
    quantity = whole(F.col("Quantity"), "Quantity")
    price = cents_of(F.col("UnitPrice").cast("double"), "UnitPrice")
    lines = invoice_line.select(
        F.col("InvoiceId").cast("bigint"),
        F.col("TrackId").cast("bigint"),
        quantity.alias("qty"),
        (price * quantity).alias("cents"),
    )
    genre_names = genre.select("GenreId", F.col("Name").alias("genre"))
    artist_names = artist.select("ArtistId", F.col("Name").alias("artist"))
    tracks = (
        track.join(genre_names, "GenreId", "left")
        .join(album, "AlbumId", "left")
        .join(artist_names, "ArtistId", "left")
        .select(F.col("TrackId").cast("bigint"), "genre", "artist")
    )
    return SalesModel(
        spark=spark,
        headers=billed.select("InvoiceId", "CustomerId", "dt"),
        billed=billed,
        lines=lines,
        tracks=tracks,
        genres=genre_names.select("genre").distinct(),
        artists=artist_names.select("artist").distinct(),
        countries=billed.select("country").filter("country IS NOT NULL").distinct(),
    )


def read_native(spark: SparkSession, folder: str) -> SalesModel:
    """:func:`native_model` over ``<folder>/<Table>.parquet``."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")

    return native_model(
        spark,
        invoice=table("Invoice"),
        invoice_line=table("InvoiceLine"),
        track=table("Track"),
        album=table("Album"),
        artist=table("Artist"),
        genre=table("Genre"),
    )
