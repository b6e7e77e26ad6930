"""Reading the landing zone and the stored tables, and writing them."""
