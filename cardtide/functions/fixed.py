"""Lookup tables, sentinel words and label texts that appear in results.

Nothing here is computed; every entry is stated as plain text in code order.
"""

from __future__ import annotations

# The 12 columns of a transaction line, in file order. All are text.
COLUMNS = (
    "id", "date", "client_id", "card_id", "amount", "use_chip",
    "merchant_id", "merchant_city", "merchant_state", "zip", "mcc", "errors",
)

# Texts that mean "no value" in key columns (compared after upper-casing where the rule says so).
MISSING_WORDS = ("", "NULL", "N/A")

UNKNOWN = "UNKNOWN"
UNKNOWN_MCC = "UNKNOWN_MCC"
ONLINE = "ONLINE"

# Merchant category codes: code, long label, short label. Code 3000 has no long label.
MCC_TABLE = (
    ("1711", "Heating, Plumbing, Air Conditioning Contractors", "HVAC Contractors"),
    ("3000", "", "Steelworks"),
    ("3001", "Steel Products Manufacturing", "Steel Mfg"),
    ("3005", "Miscellaneous Metal Fabrication", "Metal Fabrication"),
    ("3006", "Miscellaneous Fabricated Metal Products", "Metal Fabrication"),
    ("3007", "Coated and Laminated Products", "Laminated Products"),
    ("3008", "Steel Drums and Barrels", "Steel Drums"),
    ("3009", "Fabricated Structural Metal Products", "Structural Metal"),
    ("3058", "Tools, Parts, Supplies Manufacturing", "Tools/Parts Mfg"),
    ("3066", "Miscellaneous Metals", "Misc Metals"),
    ("3075", "Bolt, Nut, Screw, Rivet Manufacturing", "Fasteners Mfg"),
    ("3132", "Leather Goods", "Leather Goods"),
    ("3144", "Floor Covering Stores", "Floor Covering"),
    ("3174", "Upholstery and Drapery Stores", "Upholstery"),
    ("3256", "Brick, Stone, and Related Materials", "Building Materials"),
    ("3260", "Pottery and Ceramics", "Pottery/Ceramics"),
    ("3359", "Non-Ferrous Metal Foundries", "Metal Foundries"),
    ("3387", "Electroplating, Plating, Polishing Services", "Plating Services"),
    ("3389", "Non-Precious Metal Services", "Metal Services"),
    ("3390", "Miscellaneous Metalwork", "Metalwork"),
    ("3393", "Heat Treating Metal Services", "Heat Treating"),
    ("3395", "Welding Repair", "Welding"),
    ("3405", "Ironwork", "Ironwork"),
    ("3504", "Gardening Supplies", "Garden Supplies"),
    ("3509", "Industrial Equipment and Supplies", "Industrial Supply"),
    ("3596", "Miscellaneous Machinery and Parts Manufacturing", "Machinery Mfg"),
    ("3640", "Lighting, Fixtures, Electrical Supplies", "Lighting/Electric"),
    ("3684", "Semiconductors and Related Devices", "Semiconductors"),
    ("3722", "Passenger Railways", "Railways"),
    ("3730", "Ship Chandlers", "Ship Services"),
    ("3771", "Railroad Passenger Transport", "Railroad Passenger"),
    ("3775", "Railroad Freight", "Railroad Freight"),
    ("3780", "Computer Network Services", "Network Services"),
    ("4111", "Local and Suburban Commuter Transportation", "Transit"),
    ("4112", "Passenger Railways", "Railways"),
    ("4121", "Taxicabs and Limousines", "Taxis/Limos"),
    ("4131", "Bus Lines", "Bus Lines"),
    ("4214", "Motor Freight Carriers and Trucking", "Trucking"),
    ("4411", "Cruise Lines", "Cruise Lines"),
    ("4511", "Airlines", "Airlines"),
    ("4722", "Travel Agencies", "Travel Agencies"),
    ("4784", "Tolls and Bridge Fees", "Tolls/Bridge Fees"),
    ("4814", "Telecommunication Services", "Telecom Services"),
    ("4829", "Money Transfer", "Money Transfer"),
    ("4899", "Cable, Satellite, and Other Pay Television Services", "Cable/Satellite TV"),
    ("4900", "Utilities - Electric, Gas, Water, Sanitary", "Utilities"),
    ("5045", "Computers, Computer Peripheral Equipment", "Computer Equipment"),
    ("5094", "Precious Stones and Metals", "Jewelry/Precious"),
    ("5192", "Books, Periodicals, Newspapers", "Books/Periodicals"),
    ("5193", "Florists Supplies, Nursery Stock and Flowers", "Florists"),
    ("5211", "Lumber and Building Materials", "Lumber/Building"),
    ("5251", "Hardware Stores", "Hardware Stores"),
    ("5261", "Lawn and Garden Supply Stores", "Garden Stores"),
    ("5300", "Wholesale Clubs", "Wholesale Clubs"),
    ("5310", "Discount Stores", "Discount Stores"),
    ("5311", "Department Stores", "Department Stores"),
    ("5411", "Grocery Stores, Supermarkets", "Supermarkets"),
    ("5499", "Miscellaneous Food Stores", "Misc Food Stores"),
    ("5533", "Automotive Parts and Accessories Stores", "Auto Parts"),
    ("5541", "Service Stations", "Service Stations"),
    ("5621", "Women's Ready-To-Wear Stores", "Women's Clothing"),
    ("5651", "Family Clothing Stores", "Clothing"),
    ("5655", "Sports Apparel, Riding Apparel Stores", "Sports Apparel"),
    ("5661", "Shoe Stores", "Shoe Stores"),
    ("5712", "Furniture, Home Furnishings, and Equipment Stores", "Furniture"),
    ("5719", "Miscellaneous Home Furnishing Stores", "Home Furnishing"),
    ("5722", "Household Appliance Stores", "Appliances"),
    ("5732", "Electronics Stores", "Electronics"),
    ("5733", "Music Stores - Musical Instruments", "Music Stores"),
    ("5812", "Eating Places and Restaurants", "Restaurants"),
    ("5813", "Drinking Places (Alcoholic Beverages)", "Bars/Pubs"),
    ("5814", "Fast Food Restaurants", "Fast Food"),
    ("5815", "Digital Goods - Media, Books, Apps", "Digital Media"),
    ("5816", "Digital Goods - Games", "Digital Games"),
    ("5912", "Drug Stores and Pharmacies", "Pharmacies"),
    ("5921", "Package Stores, Beer, Wine, Liquor", "Liquor Stores"),
    ("5932", "Antique Shops", "Antique Shops"),
    ("5941", "Sporting Goods Stores", "Sporting Goods"),
    ("5942", "Book Stores", "Book Stores"),
    ("5947", "Gift, Card, Novelty Stores", "Gift Shops"),
    ("5970", "Artist Supply Stores, Craft Shops", "Art Supplies"),
    ("5977", "Cosmetic Stores", "Cosmetics"),
    ("6300", "Insurance Sales, Underwriting", "Insurance"),
    ("7011", "Lodging - Hotels, Motels, Resorts", "Hotels/Lodging"),
    ("7210", "Laundry Services", "Laundry"),
    ("7230", "Beauty and Barber Shops", "Beauty Salons"),
    ("7276", "Tax Preparation Services", "Tax Services"),
    ("7349", "Cleaning and Maintenance Services", "Cleaning Services"),
    ("7393", "Detective Agencies, Security Services", "Security Services"),
    ("7531", "Automotive Body Repair Shops", "Auto Body Repair"),
    ("7538", "Automotive Service Shops", "Auto Service"),
    ("7542", "Car Washes", "Car Washes"),
    ("7549", "Towing Services", "Towing"),
    ("7801", "Athletic Fields, Commercial Sports", "Sports Venues"),
    ("7802", "Recreational Sports, Clubs", "Sports Clubs"),
    ("7832", "Motion Picture Theaters", "Movie Theaters"),
    ("7922", "Theatrical Producers", "Theater"),
    ("7995", "Betting (including Lottery Tickets, Casinos)", "Gambling/Betting"),
    ("7996", "Amusement Parks, Carnivals, Circuses", "Amusement Parks"),
    ("8011", "Doctors, Physicians", "Doctors"),
    ("8021", "Dentists and Orthodontists", "Dentists"),
    ("8041", "Chiropractors", "Chiropractors"),
    ("8043", "Optometrists, Optical Goods and Eyeglasses", "Optometrists"),
    ("8049", "Podiatrists", "Podiatrists"),
    ("8062", "Hospitals", "Hospitals"),
    ("8099", "Medical Services", "Medical Services"),
    ("8111", "Legal Services and Attorneys", "Legal Services"),
    ("8931", "Accounting, Auditing, and Bookkeeping Services", "Accounting"),
    ("9402", "Postal Services - Government Only", "Postal Services"),
)

# US states and the federal district: code | name | region.
STATE_TABLE = (
    ("AK", "Alaska", "West"),
    ("AL", "Alabama", "Southeast"),
    ("AR", "Arkansas", "Southeast"),
    ("AZ", "Arizona", "Southwest"),
    ("CA", "California", "West"),
    ("CO", "Colorado", "West"),
    ("CT", "Connecticut", "Northeast"),
    ("DC", "District of Columbia", "Southeast"),
    ("DE", "Delaware", "Southeast"),
    ("FL", "Florida", "Southeast"),
    ("GA", "Georgia", "Southeast"),
    ("HI", "Hawaii", "West"),
    ("IA", "Iowa", "Midwest"),
    ("ID", "Idaho", "West"),
    ("IL", "Illinois", "Midwest"),
    ("IN", "Indiana", "Midwest"),
    ("KS", "Kansas", "Midwest"),
    ("KY", "Kentucky", "Southeast"),
    ("LA", "Louisiana", "Southeast"),
    ("MA", "Massachusetts", "Northeast"),
    ("MD", "Maryland", "Southeast"),
    ("ME", "Maine", "Northeast"),
    ("MI", "Michigan", "Midwest"),
    ("MN", "Minnesota", "Midwest"),
    ("MO", "Missouri", "Midwest"),
    ("MS", "Mississippi", "Southeast"),
    ("MT", "Montana", "West"),
    ("NC", "North Carolina", "Southeast"),
    ("ND", "North Dakota", "Midwest"),
    ("NE", "Nebraska", "Midwest"),
    ("NH", "New Hampshire", "Northeast"),
    ("NJ", "New Jersey", "Northeast"),
    ("NM", "New Mexico", "Southwest"),
    ("NV", "Nevada", "West"),
    ("NY", "New York", "Northeast"),
    ("OH", "Ohio", "Midwest"),
    ("OK", "Oklahoma", "Southwest"),
    ("OR", "Oregon", "West"),
    ("PA", "Pennsylvania", "Northeast"),
    ("RI", "Rhode Island", "Northeast"),
    ("SC", "South Carolina", "Southeast"),
    ("SD", "South Dakota", "Midwest"),
    ("TN", "Tennessee", "Southeast"),
    ("TX", "Texas", "Southwest"),
    ("UT", "Utah", "West"),
    ("VA", "Virginia", "Southeast"),
    ("VT", "Vermont", "Northeast"),
    ("WA", "Washington", "West"),
    ("WI", "Wisconsin", "Midwest"),
    ("WV", "West Virginia", "Southeast"),
    ("WY", "Wyoming", "West"),
)

US_STATES = tuple(row[0] for row in STATE_TABLE)

# General category by the first digit of the code.
MCC_CATEGORY_LONG = {
    "1": "Contracted Services",
    "2": "Airlines",
    "3": "Manufacturing/Industry",
    "4": "Transportation/Utilities",
    "5": "Retail/Wholesale",
    "6": "Financial Services",
    "7": "Business/Personal Services",
    "8": "Professional Services",
    "9": "Government Services",
}
MCC_CATEGORY_SHORT = {
    "1": "Contracted Services",
    "2": "Airlines",
    "3": "Manufacturing",
    "4": "Transportation",
    "5": "Retail",
    "6": "Financial",
    "7": "Services",
    "8": "Professional",
    "9": "Government",
}
# (label for other first characters, label for a blank code)
MCC_CATEGORY_OTHER = {"long": ("Other Category", "Unknown Category"), "short": ("Other", "Unknown")}

# Probable cause of errors: exact codes are tried before prefixes.
ERROR_CAUSE_BY_CODE = {
    "4121": "Taxis: mobile connectivity problems",
    "4784": "Toll systems: automated payment failures",
    "4829": "Money transfers: complex validation processes",
    "5411": "Supermarkets: high volume transactions",
    "5541": "Service stations: connectivity issues at fuel pumps",
    "5812": "Restaurants: diverse POS systems, peak hour issues",
    "5814": "Restaurants: diverse POS systems, peak hour issues",
}
ERROR_CAUSE_BY_PREFIX = {
    "49": "Transportation/Utilities: infrastructure variability",
    "54": "Automotive: automated systems, connectivity",
    "58": "Food services: peak demand, system diversity",
    "75": "Automotive services: mobile/field operations",
    "80": "Medical services: strict validation requirements",
}
ERROR_CAUSE_DEFAULT = "Standard transaction processing issues"
ERROR_CAUSE_BLANK = "Unknown error pattern"

# Transaction type by the upper-cased channel text.
TXN_TYPE_WORDS = {
    "Chip Transaction": ("Y", "YES", "TRUE", "1"),
    "Swipe Transaction": ("N", "NO", "FALSE", "0"),
    "Online Transaction": ("ONLINE",),
    "Contactless Transaction": ("CONTACTLESS",),
    "Unknown Transaction": ("", "NULL", "N/A"),
}

# Parts of the day in order: code, first hour, hour after the last, display name.
DAY_PERIODS = (
    ("MORNING", 0, 12, "Manhã"),
    ("AFTERNOON", 12, 18, "Tarde"),
    ("NIGHT", 18, 24, "Noite"),
)

# Risk categories, most severe first, with rank and lowest score.
RISK_CATEGORIES = (("CRITICAL", 4, 86), ("HIGH", 3, 61), ("MEDIUM", 2, 31), ("LOW", 1, 0))

# Patterns of the report lines (fixed values).
REPORT_CITY_STATISTICS = "Transações: %d | Total: $%.2f | Média: $%.2f"
REPORT_CITY_STATISTICS_COMPACT = "%d\t%.2f\t%.2f"
REPORT_CITY_TIME_PERIOD = "Manhã: %d (%.2f%%) | Tarde: %d (%.2f%%) | Noite: %d (%.2f%%) | Total: %d | Pico: %s"
REPORT_CITY_TIME_PERIOD_COMPACT = "%d\t%d\t%d\t%d\t%s"
REPORT_TOP_CATEGORY = "Top-%d: %s (%s) %d"
REPORT_TOP_CATEGORY_COMPACT = "%s:%d"
REPORT_CLIENT_SHARES = "Clients: %d | Low: %d (%.2f%%) | Med: %d (%.2f%%) | High: %d (%.2f%%)"
REPORT_CLIENT_RISK_CITIES = " | Top Cities (High Risk): "
REPORT_RFM_CITIES = " | Top Cities (High): "
REPORT_MERCHANT_HEALTH = (
    "Merchants: %d | Health A:%d (%.2f%%) | B:%d (%.2f%%) | C:%d (%.2f%%) | "
    "Risk Low:%d (%.2f%%) | Med:%d (%.2f%%) | High:%d (%.2f%%) | Top Merchants: %s | High-Risk Hotspots: %s"
)
REPORT_CLIENT_RISK_PROFILE = "%d\t%.2f\t%.2f\t%d\t%d\t%d\t%d\t%d\t%d\t%d\t%d\t%d"
REPORT_CLIENT_RISK_SCORE = "%s\t%.2f\t%s\t%d\t%.2f"
REPORT_RISK_HEAD = (
    "\n========== RISK CATEGORY: %s ==========\nTotal Clients: %d\nAverage Risk Score: %.2f\n"
    "Total Amount: $%.2f\nAverage Amount per Client: $%.2f\nAverage Transactions per Client: %.1f\n"
    "\n--- TOP 10 HIGHEST RISK CLIENTS ---\n"
)
REPORT_RISK_CLIENT = "%d. Client %s (Score: %.2f, Transactions: %d, Amount: $%.2f)\n   Factors: %s\n"
REPORT_RISK_END = "========================================\n"
# Shown for a client without any valid transaction: first and last timestamp.
REPORT_NO_FIRST, REPORT_NO_LAST = 9223372036854775807, -9223372036854775808
