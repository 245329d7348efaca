"""Fixed values. Results are only right if these stay exactly as they are."""

# Transaction type ids of each category.
BUCKETS = {
    "item_price_credit": (17,),
    "item_price": (18,),
    "commission": (78, 77, 2),
    "commission_credit": (19,),
    "shipping_fee": (1,),
    "shipping_fee_credit": (4,),
    "cancel_penalty_wi_24": (74,),
    "cancel_penalty_a_24": (75,),
    "consign_handling_fee": (76,),
    "down_payment_credit": (60,),
    "lost_damaged_credit": (43,),
    "storage_fee": (13,),
}
ITEM_PRICE_CREDIT = 17
ITEM_PRICE = 18
ITEM_PRICE_TYPES = (ITEM_PRICE_CREDIT, ITEM_PRICE)
COMMISSION_TYPES = BUCKETS["commission"] + BUCKETS["commission_credit"]

# General-ledger accounts.
VOUCHER_ACCOUNT = 62002
COMMISSION_VAT_ACCOUNT = 32021
COMMISSION_REVENUE_ACCOUNT = 62001
SELLER_ACCOUNT = 31002
LEDGERS_BOOKED_BY_SUBLEDGER = (13004, 33001, 31006, 33002, 84006, 32021, 94001)

# Commission is booked gross, with 9 % VAT on the net part.
GROSS_PERCENT = 109
NET_PERCENT = 100
VAT_RATE = 0.09

# The item status whose history row means "shipped".
SHIPPED_STATUS = 5

# What an uploaded ledger map may contain.
LEDGER_MAP_TYPES = ("Item Price", "Item Price Credit")
ITEM_STATUSES = (
    "delivered",
    "closed",
    "refund_reject",
    "replaced",
    "refund_completed",
    "canceled",
    "being_returned",
    "ready_for_pickup",
    "shipped",
    "pickup_return_pending",
    "packed",
    "returned",
    "returned_qcfailed",
    "refund_pending",
    "ready_for_refund",
    "replacement_pending",
)
PAYMENT_METHODS = (
    "CashOnDelivery",
    "SEP",
    "BankDeposit",
    "PEC",
    "Jiring",
    "AsanPardakht",
    "Irankish",
)
SHIPMENT_PROVIDERS = (
    "Tipax",
    "Bamilo Transportation System",
    "Post",
    "Sent by Seller",
    "Chaapaar",
    "skynet_intl",
    "NA",
    "Pishtaz",
    "PostExpress",
    "Bamilo Dropshipping",
    "TPG",
    "Tehran Orders",
    "Tpx",
)
LEDGERS = ("13004", "94001", "33001", "33002", "84006")
SUBLEDGERS = (
    "33002",
    "4000000002",
    "4000000061",
    "4000000062",
    "4000000196",
    "4000000209",
    "4000000003",
    "4000000001",
    "4000000006",
)

# Text formats. A beneficiary code has no end anchor, so longer codes pass.
SHORT_CODE_FORMAT = r"\AIR[0-9]{2}[0-9A-Z]{3}\z"
BENEFICIARY_CODE_FORMAT = r"\A3[0-9]{9}"
INTEGER_FORMAT = r"\A[-+]?(0|[1-9][0-9]*)\z"

# Error texts.
BLANK = "cannot be blank"
NOT_AN_INTEGER = "must be an integer number"
WRONG_FORMAT = "must be in a valid format"
NOT_ALLOWED = "must be a valid value"

# Heading of the posting template file.
TEMPLATE_HEADER = ("Account Code", "Account Free", "Amount")
