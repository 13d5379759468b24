"""Record layouts of the event sources, in file order (fixed values)."""

USER_BEHAVIOR = "user_id bigint, item_id bigint, category_id int, behavior string, timestamp bigint"
AD_CLICK = "user_id bigint, ad_id bigint, province string, city string, timestamp bigint"
LOGIN = "user_id bigint, ip string, event_type string, timestamp bigint"
ORDER = "order_id bigint, event_type string, tx_id string, timestamp bigint"
RECEIPT = "tx_id string, pay_channel string, timestamp bigint"
MARKET = "user_id string, behavior string, channel string, timestamp bigint"

# Unit of each layout's `timestamp` column.
TIME_UNIT = {
    USER_BEHAVIOR: "s",
    AD_CLICK: "s",
    LOGIN: "s",
    ORDER: "s",
    RECEIPT: "s",
    MARKET: "ms",
}
