"""ERP-shaped tables derived from the test data, and the checked queries over them."""
