"""A small order file of the real shape, with every kind of dirt once."""

HEADER = (
    "order_id,product_id,product_name,kategori,quantity,total_harga,"
    "tanggal_order,kota,channel,status,customer_email"
)

# A1 repeats with other spelling, A2 repeats exactly, A3 has no price and a
# priced copy, A4 a negative one, A5 zero, A6 no real date, A7 an unknown
# state, A8 an unknown product, A9 no state.
LINES = [
    'A1,P1,"Screen 24"""," elektronik",2,400000.0,03/06/2024,SURABAYA,Website,Completed, Ann@Mail.com ',
    'A1,P1,"Screen 24"""," elektronik",2,400000.0,03/06/2024,surabaya,website,completed,ann@mail.com',
    'A2,P2,Desk,Furniture,1,600000.0,15/07/2024,o\'neil town,MOBILE APP,pending,',
    'A2,P2,Desk,Furniture,1,600000.0,15/07/2024,o\'neil town,MOBILE APP,pending,',
    "A3,P1,Screen,Elektronik,3,,2024-05-18,Solo,marketplace,completed,c@mail.com",
    "A3,P1,Screen,Elektronik,3,600000.0,2024-05-18,Solo,marketplace,completed,c@mail.com",
    "A4,P2,Desk,Furniture,2,-1200000.0,2024-06-28 10:51:00,Solo,website,shipped,NA",
    "A5,P2,Desk,Furniture,2,0,\"Jun 03, 2024\",Solo,website,shipped,d@mail.com",
    "A6,P2,Desk,Furniture,1,600000.0,someday,Solo,website,completed,d@mail.com",
    "A7,P2,Desk,Furniture,1,600000.0,2024-06-01,Solo,website,returned,d@mail.com",
    "A8,P9,Lamp,Furniture,4,2600000.0,\"May 09, 2024\",Medan,MARKETPLACE,completed,none",
    "A9,P2,Desk,Furniture,1,600000.0,2024-06-01,Solo,website,,d@mail.com",
]

PRODUCTS = """product_id,product_name,kategori,harga_satuan
P1, Screen , elektronik,200000
P2,Desk,FURNITURE,600000
"""


def orders_csv(lines=LINES):
    return "\n".join([HEADER, *lines]) + "\n"
