"""End-to-end plans and the register of checked queries."""
