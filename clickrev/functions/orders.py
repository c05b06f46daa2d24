"""What a hit spends, read from its packed product list."""
from pyspark.sql import Column, functions as F

from clickrev.fixed_values import ATTRIBUTE_SEPARATOR, PRODUCT_SEPARATOR, PURCHASE_EVENT
from clickrev.functions.events import has_event
from clickrev.functions.numbers import finite_double

_REVENUE = 3


def order_total(event_list: Column, product_list: Column) -> Column:
    """Revenue of the products a hit bought, 0.0 if it bought none.

    The sum that unpacking the products, keeping those bought for more than nothing and
    adding them up would give, without a row per product.
    """

    def revenue(entry: Column) -> Column:
        return finite_double(F.get(F.split(F.trim(entry), ATTRIBUTE_SEPARATOR), F.lit(_REVENUE)))

    def add(total: Column, entry: Column) -> Column:
        return total + F.when(revenue(entry) > 0, revenue(entry)).otherwise(F.lit(0.0))

    total = F.aggregate(F.split(product_list, PRODUCT_SEPARATOR), F.lit(0.0), add)
    return F.when(has_event(event_list, PURCHASE_EVENT) & product_list.isNotNull(), total).otherwise(F.lit(0.0))
