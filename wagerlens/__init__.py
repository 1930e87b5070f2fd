"""Player-fraud and affiliate analytics as composable Spark DataFrame functions."""
