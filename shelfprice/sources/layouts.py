"""Where the fields of a listing card sit, per page layout.

A layout is data: pass other rules to the extraction to read other pages. ``cards`` and every field
hold tiers, tried in order; a tier is a group of selectors and matches the first element in document
order that fits any of them. ``link`` None means the card itself is the link. ``keep_unrooted`` and
``cut_range`` select the URL and price rules of the layout. A layout with ``sale`` and ``regular``
shows the sale price only on reduced cards.
"""

from __future__ import annotations

FIELDS = ["name", "link", "brand", "price", "original", "sale", "regular", "discount", "rating", "reviews"]

# Selectors of the three page layouts.
LAYOUTS = {
    "L": {
        "cards": ["[data-qa-locator='product-item']", "div[data-item-id]", ".Bm3ON"],
        "name": ["[class*='RfADt'] a, .RfADt a, [data-qa-locator='product-title'] a"],
        "link": ["[class*='RfADt'] a, .RfADt a, [data-qa-locator='product-title'] a"],
        "brand": [".line-clamp-1 a, [class*='BmQMo'], [class*='ICcOO']"],
        "price": ["[class*='aBrP0'], .aBrP0, [data-qa-locator='product-price'] span"],
        "original": ["[class*='WNoq3'], .WNoq3, s"],
        "discount": ["[class*='IcOsH'], .IcOsH, [class*='discount']"],
        "rating": ["[class*='bjBOp'], .bjBOp, [class*='stars'] span"],
        "reviews": ["[class*='qzqFl'], .qzqFl, [class*='review-count']"],
        "keep_unrooted": True,
        "cut_range": False,
    },
    "S": {
        "cards": ["li.shopee-search-item-result__item", "div.col-xs-2-4", "[data-sqe='item']"],
        "name": [
            "div._10Wbs-._2EWg9y, div.ie3A+n, [class*='ellipsis'], div[class*='name'], div[data-sqe='name']"
        ],
        "link": ["a[href*='/product/'], a[href*='-i.']", "a"],
        "brand": ["[class*='brand'], [class*='Brand']"],
        "price": [
            "span._341bF9, span[class*='price-section__current'], "
            "div[class*='price'] span:first-child, span[class*='_1xk7ak']"
        ],
        "original": [
            "span._1KaNOk, s, span[class*='price-before-discount'], div[class*='price'] span[class*='line-through']"
        ],
        "discount": ["div._3_ISdg, span[class*='discount'], div[class*='rebates']"],
        "rating": ["span._1lCF3A, div[class*='rating'] span, span[class*='shopee-rating-stars__score']"],
        "reviews": ["div._3-KSb6, span[class*='sold'], div[class*='rating-count']"],
        "keep_unrooted": False,
        "cut_range": True,
    },
    "Z": {
        "cards": ["a[data-test-id='productLink']"],
        "name": ["[data-test-id='productTitle']"],
        "link": None,
        "brand": ["[data-test-id='productBrandName']"],
        "sale": ["[data-test-id='specialPrice']"],
        "regular": ["[data-test-id='originalPrice']"],
        "discount": ["[data-test-id='discountPercentage']"],
        "rating": ["[data-test-id='rating']"],
        "keep_unrooted": False,
        "cut_range": True,
    },
}
