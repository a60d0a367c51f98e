"""Table layouts, declared once and never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
LINE_MONEY = T.DecimalType(18, 2)
WEIGHED = T.DecimalType(12, 3)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def products(id_type: T.DataType = T.StringType()) -> T.StructType:
    return _struct(
        product_id=id_type,
        sku=T.StringType(),
        artist=T.StringType(),
        title=T.StringType(),
        format=T.StringType(),
        genre=T.StringType(),
        condition=T.StringType(),
        cost=MONEY,
        price=MONEY,
        release_year=T.IntegerType(),
    )


def sales(id_type: T.DataType = T.StringType()) -> T.StructType:
    return _struct(
        sale_id=T.StringType(),
        sale_date=T.DateType(),
        location=T.StringType(),
        product_id=id_type,
        quantity=T.LongType(),
        unit_price=MONEY,
        discount=MONEY,
        net_amount=LINE_MONEY,
    )


def inventory(id_type: T.DataType = T.StringType()) -> T.StructType:
    return _struct(
        snapshot_date=T.DateType(),
        location=T.StringType(),
        product_id=id_type,
        quantity_on_hand=T.IntegerType(),
        days_in_stock=T.IntegerType(),
        reorder_level=T.IntegerType(),
    )


RAW_PRODUCTS = _struct(**{f.name: T.StringType() for f in products().fields})
RAW_SALES = _struct(**{f.name: T.StringType() for f in sales().fields if f.name != "net_amount"})
RAW_INVENTORY = _struct(**{f.name: T.StringType() for f in inventory().fields})

KEYS = {
    "products": ["product_id"],
    "sales": ["sale_id"],
    "inventory": ["snapshot_date", "location", "product_id"],
}

REQUIRED = {
    "products": ["product_id", "artist", "title", "format", "genre", "condition", "cost", "price"],
    "sales": [f.name for f in sales().fields],
    "inventory": [f.name for f in inventory().fields],
}

# Landed point-of-sale documents. `pull_date` and `location` come from the directory names.
_PULL = [T.StructField("pull_date", T.DateType()), T.StructField("location", T.StringType())]
_REF = _struct(id=T.StringType())


def _elements(**columns: T.DataType) -> T.StructType:
    return _struct(elements=T.ArrayType(_struct(**columns)))


def _landed(**columns: T.DataType) -> T.StructType:
    return T.StructType(_struct(**columns).fields + _PULL)


ITEMS = _landed(
    id=T.StringType(),
    name=T.StringType(),
    sku=T.StringType(),
    code=T.StringType(),
    cost=T.LongType(),
    price=T.LongType(),
    categories=_elements(name=T.StringType()),
)
ORDERS = _landed(
    id=T.StringType(),
    createdTime=T.LongType(),
    clientCreatedTime=T.LongType(),
    lineItems=_elements(
        id=T.StringType(),
        price=T.LongType(),
        unitQty=T.LongType(),
        item=_REF,
        discounts=_elements(amount=T.LongType()),
    ),
)
PAYMENTS = _landed(
    id=T.StringType(),
    createdTime=T.LongType(),
    clientCreatedTime=T.LongType(),
    amount=T.LongType(),
    tipAmount=T.LongType(),
    taxAmount=T.LongType(),
    result=T.StringType(),
    order=_REF,
)
REFUNDS = _landed(
    id=T.StringType(),
    createdTime=T.LongType(),
    amount=T.LongType(),
    payment=_REF,
)
STOCKS = _landed(
    stockCount=T.DoubleType(),
    quantity=T.DoubleType(),
    item=_REF,
)
LANDED = {
    "items": ITEMS,
    "orders": ORDERS,
    "payments": PAYMENTS,
    "refunds": REFUNDS,
    "item_stocks": STOCKS,
}
