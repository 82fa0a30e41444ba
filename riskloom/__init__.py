"""Payment-risk, anti-money-laundering and marketplace analytics as Spark DataFrame operators."""
