"""Column expressions: grid arithmetic, pixel area, tile algebra."""
