"""Inputs that several tests share."""

# Sample lines of the application format.
LINES = [
    "2024-01-15 10:30:15 [ERROR] auth-service: Login failed for user 12345 from 192.168.1.100",
    "2024-01-15 10:30:16 [INFO] api-gateway: Request processed in 45ms",
    "2024-01-15 10:30:17 [WARNING] db-service: Slow query detected: 2500ms",
    "2024-01-15 10:30:18 [DEBUG] cache-service: Cache hit for key user:42",
    "2024-01-15 10:30:19 [CRITICAL] payment-service: Gateway timeout from 10.0.0.1",
]
