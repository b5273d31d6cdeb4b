"""Lake operators and data marts for order data, written as plain DataFrame transforms."""
