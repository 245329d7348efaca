"""Settlement booking on Spark: seller transactions in, general-ledger postings out."""
