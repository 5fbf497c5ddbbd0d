"""marketlake: order-book, rate, trade, filing and news analytics as Spark DataFrame functions."""
