"""Explicit schemas of the logical tables; files are never read by inference
unless asked for."""

from pyspark.sql import types as T


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_INT, _LONG, _SHORT = T.IntegerType(), T.LongType(), T.ShortType()
_TEXT, _NUMBER, _TIME = T.StringType(), T.DoubleType(), T.TimestampType()

COUNTRIES = table(country_id=_INT, country=_TEXT, country_code=_TEXT)
VIEWERS = table(viewer_id=_INT, country_id=_INT)
VIEWS = table(viewer_id=_INT, video_id=_INT, watch_time_minutes=_INT)
VIDEOS = table(video_id=_INT, type=_TEXT, title=_TEXT, genre=_TEXT)

MEET_RESULTS = T.StructType(
    [
        T.StructField(name, _TEXT)
        for name in (
            "Name", "Sex", "Event", "Equipment", "Age", "AgeClass", "BirthYearClass",
            "Division", "Place", "Country", "State", "Federation", "ParentFederation",
            "MeetCountry", "MeetState", "MeetTown", "MeetName", "Tested", "Date",
        )
    ]
    + [
        T.StructField(name, _NUMBER)
        for name in (
            "BodyweightKg", "Squat1Kg", "Squat2Kg", "Squat3Kg", "Squat4Kg", "Best3SquatKg",
            "Bench1Kg", "Bench2Kg", "Bench3Kg", "Bench4Kg", "Best3BenchKg", "Deadlift1Kg",
            "Deadlift2Kg", "Deadlift3Kg", "Deadlift4Kg", "Best3DeadliftKg", "TotalKg",
            "Dots", "Wilks", "Glossbrenner", "Goodlift",
        )
    ]
)

DECISIONS = table(
    Pretrial_Recommendation=_TEXT, Judge_Followed_Recommendation=_TEXT, Gender=_TEXT,
    Race=_TEXT, VPRAI_Score=_INT, FTA=_TEXT, AgeAtBooking=_NUMBER, Booking_Date=_TEXT,
    Release_Type=_TEXT,
)

CASE_NOTES = table(
    Last10Chronos=_TEXT, CloseType=_TEXT, Gender=_TEXT, Race=_TEXT, Risk=_TEXT, Age=_TEXT,
    arrests_past_year=_NUMBER, ProbationType=_TEXT, DaysOnProbation=_NUMBER,
    EpicsDosagePastYear=_NUMBER,
)

COIN = table(
    id=_LONG, name=_TEXT, symbol=_TEXT, slug=_TEXT, num_market_pairs=_LONG, cmc_rank=_LONG,
    circulating_supply=_NUMBER, total_supply=_NUMBER, date_added=_TEXT, last_updated=_TEXT,
    platform=table(name=_TEXT, symbol=_TEXT, slug=_TEXT),
    quote=table(USD=table(price=_NUMBER, volume_24h=_NUMBER, last_updated=_TEXT)),
)
COIN_PAGE = table(data=T.ArrayType(COIN))

#: Types of the flattened quote snapshot once narrowed.
QUOTES = table(
    id=_INT, name=_TEXT, symbol=_TEXT, circulating_supply=T.FloatType(),
    total_supply=T.FloatType(), cmc_rank=_SHORT, quote_USD_price=T.FloatType(),
    quote_USD_volume_24h=T.FloatType(), timestamp=_TIME,
)

_AMOUNT = table(amount=_NUMBER)
RECEIPT = table(
    receipt_id=_LONG, buyer_user_id=_LONG, name=_TEXT, email=_TEXT, payment_status=_TEXT,
    grandtotal=table(amount=_NUMBER, currency_code=_TEXT), shipping_cost=_AMOUNT,
    creation_tsz=_LONG, last_modified_tsz=_LONG,
)
RECEIPT_PAGE = table(results=T.ArrayType(RECEIPT))
VARIATION = table(property_id=_LONG, value=_TEXT)
SALE_LINE = table(
    transaction_id=_LONG, receipt_id=_LONG, listing_id=_LONG, title=_TEXT, quantity=_LONG,
    price=_TEXT, sku=_TEXT, variations=T.ArrayType(VARIATION),
)
SALE_LINE_PAGE = table(results=T.ArrayType(SALE_LINE))
FULFILMENT = table(
    id=_TEXT, status=_TEXT, shipped_at=_TEXT,
    items=T.ArrayType(
        table(referenceId=_LONG, cost=_NUMBER, shipping_method=_TEXT, tracking_number=_TEXT)
    ),
)
FULFILMENT_PAGE = table(orders=T.ArrayType(FULFILMENT))
ORDER_DETAIL = table(
    id=_TEXT,
    receipts=T.ArrayType(
        table(productsPriceInitial=_NUMBER, shippingPrice=_NUMBER, totalVat=_NUMBER)
    ),
)
